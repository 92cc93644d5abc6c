import hashlib
import re
import time

from tests.llm.helpers import SF001, empty_docs, odd_docs, odd_rows, table
from tiertrip.llm import pii, registry, weak_labels

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, digits[::-1]))) % 10
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split("."))
                    or kind == "card" and (luhn or not 16 <= len(digits) <= 19)
                    or kind == "phone" and not 8 <= len(digits) <= 15):
                continue
            out.append((kind, *m.span()))
    return out


TRICKY = ["a@b.c.d@e.f x@y", "@a.b @@ a@b..c", "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.1.", "01.002.0003.4", "+1 (2) 3-4.5 6 78",
          "+12 345 678 9 4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112 41111111 1111 1111",
          "++1 234 567 890+1 2 3", "x%y@z-.q.w é@a.b", "tel +1 (314) 555-6532 4663622617512349 end", "5 - 5 55  55"]


def test_base_spans_equal_plain_regular_expressions():
    texts = TRICKY + [t for t, in table(SF001, "SELECT text FROM documents")]
    for t in texts:
        assert pii.base_spans(t) == brute(t), t


def test_long_runs_take_linear_time():
    began = time.time()
    for c in "7a@+.- ":
        text = c * 200_000
        pii.candidates(text, pii.base_spans(text))
    pii.candidates("1." * 100_000, [])
    pii.candidates("a." * 100_000 + "@", [])
    assert time.time() - began < 20


def test_em_finds_reliable_voters():
    patterns = [(0, "yy-", 500), (0, "nn-", 300), (0, "ynn", 20), (0, "yyn", 60), (0, "nny", 5), (0, "--n", 40)]
    model = weak_labels.fit(patterns, 3)
    assert model.posterior(0, "yy-") > 0.9 > 0.1 > model.posterior(0, "nn-")
    assert weak_labels.fit([], 3).log_odds().shape == (3, 2)


def test_query_adds_swallowed_spans_and_keeps_base(spark):
    rows = [(i, f"word call +1 (314) 555-65{i:02d} 4111111111111111 end a{i}@b.com 10.2.3.{i}") for i in range(30)]
    rows += [(100 + i, f"plain 41111111111{i:05d} text") for i in range(30)] + [(200, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in pii.find(docs).withColumn("spans", pii.as_text("found")).collect()}
    for i, text in rows:
        base = [f"{k}:{a}:{b}" for k, a, b in brute(text)]
        assert out[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(filter(None, out[i]["spans"].split(",")))
    kinds = [s.split(":")[0] for s in out[3]["spans"].split(",")]
    assert kinds == ["email", "ip", "card", "phone"]
    assert out[200]["spans"] == ""
    clean = [i for i in range(100, 130) if not brute(dict(rows)[i])]
    assert clean and all(out[i]["spans"] == "" for i in clean)


def test_odd_rows(spark):
    assert pii.find(odd_docs(spark)).count() == len(odd_rows())
    assert pii.find(empty_docs(spark)).count() == 0
    assert registry.op1_weak_pii(spark, SF001).columns[:7] == [
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]


def test_span_proposals_are_near_linear():
    import time
    from tiertrip.llm import pii
    text = lambda n: "\n".join(f"call {2 + i % 8}{i % 7}2-55{i % 10}-{i % 10000:04d} or so" for i in range(n))
    took = []
    for n in (10_000, 100_000):
        t = time.thread_time()
        found = pii._proposed(text(n), pii.base_spans(text(n)))
        took.append(time.thread_time() - t)
        assert len(found) >= n
    assert took[1] < 40 * took[0]
    spans = pii._Taken([(0, 5), (2, 3), (10, 20), (30, 31)])
    for a in range(35):
        for b in range(a + 1, 36):
            assert spans.touches(a, b) == any(a < y and x < b for x, y in spans.spans)
