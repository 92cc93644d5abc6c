"""Token ids of texts in binary files: ids ranked by corpus frequency, byte-aligned codes of variable length.

``write`` encodes every text with a given tokenizer (never trained here), counts all ids, ranks them by
frequency and writes shards in ascending id order; ``read`` gives the documents back from the files.

File format, all numbers little-endian. A shard holds whole documents:

    header      8 bytes ``TOKVB01\\n``, then int64 documents, control bytes, data bytes, crc32 of the codebook
    documents   int64 id, int64 ids of the document, uint8 1 if the id is NULL: three arrays
    control     one byte for four ranks, two bits each: the rank has 0, 1, 2 or 4 data bytes (rank 0 has none)
    data        the ranks' bytes, one after the other

A document begins at a new control byte, so its last byte may have unused codes, which are 0 and have no
data. ``codebook.u32`` has the id of each rank. ``manifest`` (Parquet) names the shards that count, in
order: a task that is run again writes a shard under another name, and only the attempt that Spark commits
is in the manifest.

Decoding is table lookup: the control byte gives its four lengths, their running sum the offsets, and one
gather with a mask the values.

Rows: NULL texts count as empty and get the end id alone; NULL ids come first; rows with one id lie side by
side in an order set by their tokens, so copies and equal ids need no rule and a hot id is spread over
tasks. Ids must be integers (cast to bigint). A very long text is encoded word by word into one buffer of
its ids; one text may have up to 2^29 ids (the size of a binary value). Other columns are not read. An empty
table gives no shard and no row. Working memory is bounded by ``CHUNK`` and ``CODED``, or by the longest text.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tiertrip.session import arrow_files, remove_path, run_path

from .common import col

MAGIC = b"TOKVB01\n"
#: Ids in a shard, about: 30 to 60 MB of file. A task holds one shard.
SHARD_IDS = 1 << 25
#: Shards in a block of the running sum over shards.
BLOCK = 1000
#: Pieces or words in a generation of a worker's encoder (some 80 MB), and the greatest length of one.
CACHE_PARTS, CACHE_LENGTH = 400_000, 64
#: Bytes of texts that are cut into pieces together, and ids that are coded together, at least one text each.
CHUNK, CODED = 1 << 23, 1 << 20

# The steps of a tokenizer file that the word-wise encoder below reproduces.
_NORMAL = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts of ASCII and Latin-1 letters: in lower case each of their bytes is of one of the kinds below.
_PLAIN = re.compile("[\x20-\x7e\t-\rÀ-ÖØ-öø-ÿ]*\\Z")
_SPACE, _LETTER, _DIGIT, _SIGN = range(4)
_KIND = np.array([_LETTER if b >= 0x80 or chr(b).islower() else _DIGIT if chr(b).isdigit() else _SPACE if chr(b).isspace() else _SIGN
                  for b in range(256)], np.uint8)


def split_plain(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The pieces of plain texts in lower case, one after the other, and how many there are up to each text's
    end. The split above in terms of bytes: a piece is a run of letters, one digit, or a run of signs, and where a
    run of signs is one apostrophe, it takes a following s, t, re, ve, m, ll or d from the letters."""
    raw = np.frombuffer(b" ".join(texts) + b"   ", np.uint8)
    kind = _KIND[raw]
    solid = kind != _SPACE
    begins = solid.copy()
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    at = np.flatnonzero((raw == ord("'")) & begins)
    one, two = raw[at + 1], raw[at + 2]
    short = np.isin(one, list(b"stmd"))
    long = np.isin(one, list(b"rv")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    after = (at + 2 + long)[short | long]
    begins[at[short | long] + 1] = False
    begins[after] = solid[after]
    ends = np.searchsorted(np.flatnonzero(begins), np.cumsum([len(t) + 1 for t in texts]))
    kept, first = raw[solid], np.flatnonzero(begins[solid])
    offsets = np.append(first, len(kept)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]), ends


class Encoder:
    """Ids of texts (UTF-8 bytes) as bytes of ``dtype``, by the tokenizers library.

    A tokenizer of the steps above drops white space and never looks across it. So texts of ASCII and
    Latin-1 letters (which the normal form leaves as they are) are cut into the pieces of the tokenizer's own
    split, many texts at a time; each distinct piece of these goes once to its model, and its ids are laid
    out wherever it occurs. Any other text is encoded word by word by the whole tokenizer, each distinct word
    once. A tokenizer with other steps gets whole texts. Pieces and words are kept in two generations: when
    the young one is full it becomes the old one, which is dropped."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            steps = json.load(f)
        normal = [n.get("type") for n in (steps.get("normalizer") or {}).get("normalizers", [])]
        before = (steps.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.wordwise = (normal == _NORMAL and before[0].get("pattern") == {"Regex": _SPLIT} and before[0].get("invert")
                         and [p.get("type") for p in before[1:]] == ["ByteLevel"] and not steps["model"].get("dropout")
                         and not steps.get("post_processor"))
        self.added = tuple(t["content"].encode() for t in steps.get("added_tokens", []))
        self.wordwise = self.wordwise and not any(t.split() != [t] for t in self.added)
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.model = self.tokenizer.model
        self.level = {ord(c): level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xC0, 0x100))}
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.young: dict[str | bytes, bytes] = {}
        self.old: dict[str | bytes, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.dtype.itemsize == 2 else 'I'}", *ids)

    def encode(self, raw: bytes) -> bytes:
        return self.encode_all([raw])[0]

    def encode_all(self, raws: list[bytes | None]) -> list[bytes]:
        """The ids of each text; none for a NULL or empty one."""
        out, plain, at, size = [b""] * len(raws), [], [], 0
        for i, raw in enumerate(raws):
            if not raw:
                continue
            text = raw.decode("utf-8", "replace")
            if not self.wordwise:
                out[i] = self._whole(text)
            elif _PLAIN.match(text) and not any(t in raw for t in self.added):
                lower = text.lower().encode()
                if plain and size + len(lower) > CHUNK:
                    self._plain(plain, at, out)
                    plain, at, size = [], [], 0
                plain.append(lower)
                at.append(i)
                size += len(lower)
            else:  # bytes are split at ASCII white space only; a word's key is a string, a piece's is bytes
                out[i] = b"".join([self._kept(" " + w.decode("utf-8", "replace"), self._whole) for w in raw.split()])
        if plain:
            self._plain(plain, at, out)
        return out

    def _plain(self, texts: list[bytes], at: list[int], out: list[bytes]) -> None:
        pieces, ends = split_plain(texts)
        if not len(pieces):
            return
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        found = list(map(self.young.get, distinct))
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = self._kept(distinct[i], self._piece)
        pool, which = np.frombuffer(b"".join(found), self.dtype), coded.indices.to_numpy()
        each = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        counts = each[which]
        stop = np.cumsum(counts)
        shift = (np.cumsum(each) - each)[which] - (stop - counts)
        flat = pool[np.repeat(shift, counts) + np.arange(int(stop[-1]))].tobytes()
        lo = 0
        for i, hi in zip(at, (np.append(0, stop)[ends] * self.dtype.itemsize).tolist()):
            out[i], lo = flat[lo:hi], hi

    def _kept(self, part: str | bytes, make) -> bytes:
        ids = self.young.get(part)
        if ids is None:
            ids = self.old.get(part)
            if ids is None:
                ids = make(part)
            if len(part) <= CACHE_LENGTH:
                if len(self.young) >= CACHE_PARTS:
                    self.old, self.young = self.young, {}
                self.young[part] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: bytes) -> bytes:
        found = self.model.tokenize(piece.decode() if piece.isascii() else piece.decode().translate(self.level))
        return self.pack([t.id for t in found])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process, kept with its words from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_texts(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, ids`` for every row: the ids of the whole text and ``end_id``, packed little-endian in two
    bytes each (four for a vocabulary of over 65,536)."""
    def run(batches):
        enc = encoder(tokenizer)
        end = enc.pack([end_id])
        for b in batches:
            raw = b.column(1).cast(pa.binary()).to_pylist()
            yield pa.record_batch([b.column(0), pa.array([ids + end for ids in enc.encode_all(raw)], pa.binary())],
                                  names=["id", "ids"])

    picked = docs.select(col(doc_id).cast("long").alias("id"), col(text).cast("string").alias("text"))
    return picked.mapInArrow(run, "id long, ids binary")


def frequency_ranks(encoded: DataFrame, size: int, dtype: np.dtype) -> np.ndarray:
    """The vocabulary's ids by falling count over all rows, ties by id. One sum of each id a task, added up
    by Spark; what comes to the driver is bounded by the vocabulary."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            ids = np.frombuffer(b"".join(b.column(0).to_pylist()), dtype)
            for lo in range(0, len(ids), CODED):
                total += np.bincount(ids[lo:lo + CODED], minlength=size)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["id", "n"])

    counted = encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(size, np.int64)
    for r in counted.collect():
        counts[r["id"]] = r["n"]
    return np.lexsort((np.arange(size), -counts)).astype("<u4")


# Data bytes of each two-bit code, and which of a rank's four bytes those are.
_BYTES = np.array([0, 1, 2, 4])
_TAKEN = np.arange(4) < _BYTES[:, None]
#: The four lengths of every control byte.
_LENGTHS = _BYTES[(np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3].astype(np.int64)
#: What each length takes of a rank's first two data bytes.
_MASKS = np.array([0, 0xFF, 0xFFFF, 0, 0xFFFF], np.uint16)


def code_ranks(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(control, data) of documents' ranks, laid one after the other; ``counts`` has their lengths."""
    width = (counts + 3) // 4 * 4
    slots = np.zeros(int(width.sum()), "<u4")
    shift = np.cumsum(width) - width - (np.cumsum(counts) - counts)
    slots[np.arange(len(ranks)) + np.repeat(shift, counts)] = ranks
    code = ((slots > 0).astype(np.uint8) + (slots > 0xFF) + (slots > 0xFFFF)).reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    return control.astype(np.uint8), slots.view(np.uint8).reshape(-1, 4)[_TAKEN[code.ravel()]]


def decode_ranks(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranks of whole documents from their control and data bytes."""
    length = _LENGTHS[control].ravel()
    at = np.cumsum(length) - length
    padded = np.append(data, np.zeros(4, np.uint8))
    pairs = padded[:-1] | padded[1:].astype(np.uint16) << 8
    slots = (pairs[at] & _MASKS[length]).astype(np.uint32)
    here = np.flatnonzero(length == 4)
    slots[here] |= pairs[at[here] + 2].astype(np.uint32) << np.uint32(16)
    width = (counts + 3) // 4 * 4
    shift = np.cumsum(width) - width - (np.cumsum(counts) - counts)
    return slots[np.arange(int(counts.sum())) + np.repeat(shift, counts)]


def _put(folder: str, name: str, parts: list[bytes]) -> int:
    """Write under a name that nothing reads yet, then move: a file is whole or not there."""
    files, root = arrow_files(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/.{name}") as f:
        for p in parts:
            f.write(p)
    files.move(f"{root}/.{name}", f"{root}/{name}")
    return sum(map(len, parts))


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
          shard_ids: int = SHARD_IDS) -> None:
    """Write the ids of all texts, each with ``end_id`` after it, below ``path`` in ascending order of
    ``doc_id``. Texts are tokenized once, into a table of the shared folder that goes after use; a range
    shuffle orders its rows, and each task writes its rows as shards of about ``shard_ids`` ids."""
    from pyspark import TaskContext
    spark = docs.sparkSession
    enc = encoder(tokenizer)
    dtype, size = enc.dtype, enc.size
    stage = run_path(spark, "llm", f"tokens-{uuid.uuid4().hex}")
    encode_texts(docs, tokenizer, end_id, doc_id, text).write.option("compression", "zstd").parquet(stage)
    encoded = spark.read.schema("id long, ids binary").parquet(stage)
    by_rank = frequency_ranks(encoded, size, dtype)
    book = by_rank.tobytes()
    _put(path, "codebook.u32", [book])
    rank_of = np.empty(size, "<u4")
    rank_of[by_rank] = np.arange(size, dtype="<u4")
    shared = spark.sparkContext.broadcast(rank_of)  # four bytes for each id of the vocabulary
    signature = zlib.crc32(book)

    def shards(batches):
        ranks, part, k = shared.value, TaskContext.get().partitionId(), 0
        attempt = uuid.uuid4().hex
        held, n = [], 0

        def flush():
            ids = np.concatenate([h[0] for h in held])
            counts = np.concatenate([h[1] for h in held])
            null = np.concatenate([h[2] for h in held])
            control, data = [h[3] for h in held], [h[4] for h in held]
            head = np.array([len(ids), sum(map(len, control)), sum(map(len, data)), signature], "<i8")
            name = f"{part:06d}-{k:05d}-{attempt}.ids"
            size = _put(path, name, [MAGIC, head.tobytes(), ids.astype("<i8").tobytes(), counts.astype("<i8").tobytes(),
                                     null.tobytes(), *(c.tobytes() for c in control), *(d.tobytes() for d in data)])
            return pa.record_batch([pa.array([v]) for v in (name, part, k, len(ids), int(counts.sum()), size)],
                                   names=["file", "part", "piece", "documents", "ids", "bytes"])

        for b in batches:
            lo = 0
            lengths = np.array([len(v) // dtype.itemsize for v in b.column(1).to_pylist()], np.int64)
            total = np.cumsum(lengths)
            while lo < len(lengths):  # rows up to the shard's bound and those coded together, one at least
                if held and n + int(lengths[lo]) > shard_ids:
                    yield flush()
                    held, n, k = [], 0, k + 1
                before = int(total[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(total, before + min(shard_ids - n, CODED), "right")))
                rows = b.slice(lo, hi - lo)
                packed = np.frombuffer(b"".join(rows.column(1).to_pylist()), dtype)
                ids = rows.column(0)
                held.append((ids.fill_null(0).to_numpy(zero_copy_only=False), lengths[lo:hi],
                             ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                             *code_ranks(ranks[packed], lengths[lo:hi])))
                n += int(lengths[lo:hi].sum())
                lo = hi
        if held:
            yield flush()

    tie = F.xxhash64("ids")  # rows of one id are spread too
    ordered = encoded.repartitionByRange(F.col("id").asc_nulls_first(), tie).sortWithinPartitions(
        F.col("id").asc_nulls_first(), tie, "ids")
    ordered.mapInArrow(shards, "file string, part long, piece long, documents long, ids long, bytes long"
                       ).write.mode("overwrite").parquet(f"{path}/manifest")
    remove_path(spark, stage)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row a shard: its place in the order, sizes, and ``start``, the ids in all shards before it. The
    running sum is taken within blocks of 1,000 shards, and over the blocks' sums."""
    found = spark.read.schema("file string, part long, piece long, documents long, ids long, bytes long").parquet(f"{path}/manifest")
    found = found.withColumn("block", F.floor(F.col("part") / BLOCK))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = found.groupBy("block").agg(F.sum("ids").alias("n")).select(
        "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("block").orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("earlier", F.coalesce(F.sum("ids").over(within), F.lit(0))).join(blocks, "block").select(
        "file", "part", "piece", "documents", "ids", "bytes", (F.col("base") + F.col("earlier")).alias("start"))


def read_shard(path: str, name: str, by_rank: np.ndarray, step: int = 1 << 20):
    """(id, NULL flag, ids) of a shard's documents in order, decoded ``step`` ids or one document at a time."""
    files, root = arrow_files(path)
    with files.open_input_stream(f"{root}/{name}") as f:
        raw = np.frombuffer(f.read(), np.uint8)
    if raw[:8].tobytes() != MAGIC:
        raise ValueError(f"{name} is no token file")
    n, controls, datas, signature = raw[8:40].view("<i8")
    if signature != zlib.crc32(by_rank.tobytes()) or len(raw) != 40 + 17 * n + controls + datas:
        raise ValueError(f"{name} is cut or of another codebook")
    ids, counts, null = raw[40:40 + 8 * n].view("<i8"), raw[40 + 8 * n:40 + 16 * n].view("<i8"), raw[40 + 16 * n:40 + 17 * n]
    control = raw[40 + 17 * n:40 + 17 * n + controls]
    data = raw[40 + 17 * n + controls:]
    total, lo, c, d = np.cumsum(counts), 0, 0, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + step, "right")))
        here = control[c:c + int(((counts[lo:hi] + 3) // 4).sum())]
        size = int(_LENGTHS[here].sum())
        ranks = decode_ranks(here, data[d:d + size], counts[lo:hi])
        yield ids[lo:hi], null[lo:hi].astype(bool), counts[lo:hi], by_rank[ranks]
        lo, c, d = hi, c + len(here), d + size


def read(spark: SparkSession, path: str) -> DataFrame:
    """``id, start, n_tokens, ids`` of every document in the files: ``start`` counts the ids of all
    documents before it, ``ids`` holds its ids as little-endian unsigned 32-bit integers."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        by_rank = None
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if by_rank is None:
                    files, root = arrow_files(path)
                    with files.open_input_stream(f"{root}/codebook.u32") as f:
                        by_rank = np.frombuffer(f.read(), "<u4")
                for ids, null, counts, tokens in read_shard(path, name, by_rank):
                    end = np.cumsum(counts)
                    cuts = (np.append(0, end) * 4).astype(np.int32)
                    raw = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(cuts), pa.py_buffer(tokens)])
                    yield pa.record_batch([pa.array(ids, mask=null), pa.array(start + end - counts), pa.array(counts), raw],
                                          schema=_arrow)
                    start += int(end[-1])

    _arrow = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    shards = manifest(spark, path)
    tasks = min(max(1, spark.read.parquet(f"{path}/manifest").count()), 10_000)
    return shards.select("file", "start").repartition(tasks).mapInArrow(run, schema)
