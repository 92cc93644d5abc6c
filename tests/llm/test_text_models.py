import collections
import time
import zlib

import numpy as np
import pytest

from tests.llm.helpers import SF01, empty_docs, odd_docs, odd_rows, table
from tiertrip.llm import langid, registry, toxicity


def grams(text, sizes=(1, 2, 3)):
    words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
    out = collections.Counter()
    for w in words:
        out.update(w[i:i + 1] for i in range(len(w)) if 1 in sizes)
        padded = f" {w} "
        for n in sizes:
            if n > 1:
                out.update((n, padded[i:i + n]) for i in range(len(padded) - n + 1))
    return out


def test_ngrams_are_counted_within_words():
    for text in ["That it.", "Ünï côde  1x2!", "a", "", "...", "ab ab\nabc"]:
        found = collections.Counter(langid.ngrams(text).tolist())
        assert sorted(found.values()) == sorted(grams(text).values())


def test_out_of_place_distance():
    known = {"aa": ["the", "of", "and"], "bb": ["der", "die", "und"]}
    ranked = {}
    for lang, words in known.items():
        ranked[lang] = [int(g) for g in langid.top_ranks(" ".join(words * 3 + words[:1] * 2), (1, 2, 3), 40)[0]]
    p = langid.Profiles(ranked, 40, (1, 2, 3))
    assert p.predict("and the of the")[0] == "aa" and p.predict("und der die")[0] == "bb"
    text = "the und"
    own, ranks = langid.top_ranks(text, (1, 2, 3), 40)
    away = [sum(abs(ranked[lang].index(int(g)) - r) if int(g) in ranked[lang] else 40 for g, r in zip(own, ranks))
            for lang in ("aa", "bb")]
    assert p.predict(text) == (("aa", "bb")[int(np.argmin(away))], 1 - min(away) / (40 * len(own)))
    assert p.predict(None) == p.predict("") == p.predict("12 !?") == ("und", 0.0)


def test_language_query_on_held_out_rows(spark):
    out = {r["doc_id"]: r for r in registry.op6_rank_order_profiles(spark, SF01).collect()}
    assert len(out) == 1000
    hits = []
    for i, lang in table(SF01, "SELECT doc_id, lang FROM documents"):
        assert out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= out[i]["score"] <= 1
        hits += [out[i]["lang_pred"] == lang] if out[i]["held_out"] else []
    assert np.mean(hits) > 0.97


def test_language_sample_bound_and_odd_rows(spark):
    docs = odd_docs(spark)
    profiles = langid.fit(docs, rows_per_lang=1)
    out = docs.select(langid.predict(docs["text"], profiles).alias("p")).collect()
    assert len(out) == len(odd_rows())
    kept = langid.keep_identified(docs, langid.fit(docs))
    assert kept.columns == docs.columns
    assert kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in odd_rows())
    none = langid.fit(empty_docs(spark))
    assert none.predict("some words") == ("und", 0.0) and langid.keep_identified(empty_docs(spark), none).count() == 0


def test_texts_that_share_no_ngram_are_not_identified(spark):
    known = spark.createDataFrame([(1, "the quiet river", "en"), (2, "der alte fluss", "de")], "doc_id long, text string, lang string")
    docs = spark.createDataFrame([(3, "\u6cb3\u6d41 \u77f3\u6865", "zh"), (4, "old river", None), (5, "\u6cb3 the \u6d41", None), (6, "12", None)],
                                 known.schema)
    profiles = langid.fit(known)
    assert profiles.predict("\u6cb3\u6d41") == ("de", 0.0)  # the column of op6 stays
    assert sorted(r["doc_id"] for r in langid.keep_identified(docs, profiles).collect()) == [4, 5]


def model_of(spark, texts):
    return toxicity.char_model(spark.createDataFrame([(t,) for t in texts], "text string"))


CLEAN = ["the quiet river runs under the old stone bridge in the morning", "people walk to the market and buy bread"] * 20
RUDE = ["you are a stupid loser and a worthless clown", "what a pathetic idiot you are", "stupid trash from a moron"]


def test_restoring_disguised_words(spark):
    model = model_of(spark, CLEAN + RUDE * 3)
    restorer = toxicity.Restorer(model)
    for disguised, plain in [("stup1d", "stupid"), ("l0ser", "loser"), ("tr@sh", "trash"), ("m0r0n", "moron"),
                             ("stuuuupid", "stupid"), ("cl0wn", "clown"), ("w0rthle$$", "worthless")]:
        assert plain in restorer.words(f"say {disguised} now"), disguised
    assert "stupid" in restorer.words("oh s t u p i d thing") and "moron" in restorer.words("m-o-r-o-n")
    assert restorer.words("plain words*** with&&& marks!!") == {"plain", "words", "with", "marks"}
    assert restorer.words(None) == restorer.words("") == restorer.words("12 34 !!") == set()


def test_spelled_out_words_beside_other_single_letters(spark):
    restorer = toxicity.Restorer(model_of(spark, CLEAN + RUDE * 3))
    for spelled, plain in [("a s t u p i d man", "stupid"), ("y o u i d i o t", "idiot"), ("$ t u p i d", "stupid"),
                           ("1 d i o t", "idiot"), ("a-m-0-r-o-n", "moron"), ("you l 0 $ e r", "loser")]:
        assert plain in restorer.words(spelled), spelled
    assert "you" in restorer.words("y o u i d i o t") and "shit" in restorer.words("s h ! t")
    assert restorer.words("1 2 3 4 5 $ 7") == set()


def test_separators_of_any_kind(spark):
    restorer = toxicity.Restorer(model_of(spark, CLEAN + RUDE * 3))
    for spelled in ("s  t  u  p  i  d", "s.t-u p.i-d", "s\nt\nu\np\ni\nd", "s...t...u...p...i...d", "stu-pid", "stu\u2014pid", "stu...pid",
                    "stu-\npid", "stu\u00adpid", "\uff53\uff54\uff55\uff50\uff49\uff44", "\uff33 t u p i d", "s - t - u - p - i - d"):
        assert "stupid" in restorer.words(f"what a {spelled}"), spelled
    model = toxicity.Model(restorer, {"stupid": 0.9, "mor~": 0.5}, 0.05)
    assert model.score("so stu pid of you") == model.score("so stupid of you") == pytest.approx(1 - 0.95 * 0.1)
    assert model.score("a stu. Not a pid") == model.score(None) == pytest.approx(0.05)
    assert restorer.words("a far-known river") == {"a", "far", "known", "river", "farknown"}


def test_letters_beyond_the_first_planes_are_counted(spark):
    model = model_of(spark, ["\u6c34\u6c34\u6c34 \U00020000\U00020000\U00020000"] * 50)
    for c in ("\u6c34", "\U00020000"):
        k = toxicity._class(c)
        assert k >= 27 and toxicity._classes()[ord(c)] == k and model.cost[k, k, k] < 1.5


def test_lexicon_from_a_bounded_sample(spark):
    docs = spark.createDataFrame([(i, f"calm words here number n{i}x" + (" vile" if i % 4 == 0 else "") + (" long" + "q" * 5000 if i == 3 else ""))
                                  for i in range(80)] + [(99, " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(5000)))],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)] + [(99, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, train_words=2000)  # the long document is passed over, the rest is learned from
    assert model.score("a vile thing") > 0.5 > model.score("calm words")


def test_long_disguises_are_restored(spark):
    restorer = toxicity.Restorer(model_of(spark, CLEAN + RUDE * 3))
    sentence = "the old stone bridge is under a stupid loser and a worthless moron"
    assert {"stupid", "loser", "worthless", "moron"} <= restorer.words("-".join(sentence.replace(" ", "")))
    assert "stupid" in restorer.words("st" + "u" * 90 + "pid")
    assert restorer.words("l0ser" * 20) == {"loser" * 20, "l", "ser", "serl"}


def test_disguised_ends_and_doubled_letters(spark):
    restorer = toxicity.Restorer(model_of(spark, CLEAN + RUDE * 3 + ["you ass what a waste of letters"] * 5))
    for disguised, plain in [("idio7", "idiot"), ("a$$", "ass"), ("a55", "ass"), ("wast3", "waste"), ("stuupid", "stupid"),
                             ("idiiot", "idiot"), ("tra$h!!", "trash")]:
        assert any(w.startswith(plain) for w in restorer.words(f"so {disguised}, then")), disguised
    assert restorer.words("stupid! morning!! (bread) river* letters") == {"stupid", "morning", "bread", "river", "letters"}


def test_long_runs_take_linear_time(spark):
    restorer, began = toxicity.Restorer(model_of(spark, CLEAN)), time.time()
    for piece in ("*", "7", "a", "a ", "a-", "*a", "a*", "$$a", "1a ", "é"):
        restorer.words(piece * 100_000)
    assert time.time() - began < 20


def test_decoding_equals_all_paths(spark):
    model = model_of(spark, CLEAN + RUDE * 3)

    def best(word):
        options = [[(x, toxicity.SUBSTITUTE) for x in toxicity.LOOK_ALIKES[c]] + [("", toxicity.LEAVE_OUT)]
                   if c in toxicity.LOOK_ALIKES else [(c, 0.0)] for c in word] + [[(" ", 0.0)]]
        paths = [("", 0.0)]
        for step in options:
            paths = [(p + c, t + e) for p, t in paths for c, e in step]
        ends = []
        for text, total in paths:
            a = b = 0
            for ch in text:
                k = toxicity._class(ch)
                total += float(model.cost[a, b, k])
                a, b = b, k
            ends.append((total, text.strip()))
        return min(ends)[1]

    for w in ["1d1ot", "st0p", "tr4$h", "l0s3r", "m0r0n"]:
        assert toxicity.decode(w, model) == best(w)


def test_only_near_copies_are_left_out_of_the_lexicon():
    shared = [f"word{i}" for i in range(60)]
    other = [sorted(shared + [f"own{d}x{i}" for i in range(20)]) for d in range(300)]  # any two: Jaccard 0.6
    copies = [sorted(other[0] + [f"more{d}"]) for d in range(40)]
    docs = other + copies + [[], []]
    labels = np.array([float(d % 2) for d in range(300)] + [0.0] * 40 + [0.0, 0.0])
    kept = toxicity._apart(docs, labels)
    assert kept == [*range(300), 340]
    few = [sorted(shared + [f"own{d}x{i}" for i in range(20)] + ["vile"] * (d < 4)) for d in range(40)]
    lexicon, _ = toxicity.fit_lexicon(few, np.array([float(d < 4) for d in range(40)]))
    assert "vile" in lexicon


def test_toxicity_query_on_labels(spark):
    out = {r["doc_id"]: r for r in registry.op9_noisy_channel_toxicity(spark, SF01).collect()}
    assert len(out) == 1000
    hits, false = [], 0
    for i, y in table(SF01, "SELECT doc_id, toxic FROM labels"):
        r = out[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        hits += [r["predicted"] == y] if r["held_out"] else []
        false += r["predicted"] > y
    assert np.mean(hits) > 0.9 and false <= 2


def test_toxicity_odd_rows(spark):
    docs, labels = odd_docs(spark), spark.createDataFrame([(5, 1), (7, 0), (9, 0), (8, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    rows = docs.select(toxicity.score(docs["text"], model).alias("s")).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["s"] <= 1 for r in rows)
    none = toxicity.fit(empty_docs(spark), labels)
    assert none.score("any words") == 0.0


def test_marks_alone_are_no_language_and_many_languages_are_learned(spark):
    rows = [(i, f"wort{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} und haus " * 3, f"l{i:05d}") for i in range(2300)]
    rows += [(10_000 + i, "the river walks under a bright evening", "en") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = langid.fit(docs, top=20)
    assert len(profiles.langs) == langid.MAX_LANGS and "en" in profiles.langs
    assert profiles.predict("the bright river")[0] == "en"
    assert profiles.predict("\u0301\u0301") == ("und", 0.0) and profiles.predict(None) == ("und", 0.0)
    assert langid.fit(docs, most_langs=1).langs == ["en"]


def test_profile_distance_is_the_out_of_place_sum():
    import random
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(40)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    ranked = {}
    for lang in ("x", "y", "z"):
        grams, _ = langid.top_ranks(text(80), (1, 2, 3), 50)
        ranked[lang] = [int(g) for g in grams]
    profiles = langid.Profiles(ranked, 50, (1, 2, 3))
    for n in (1, 3, 30):
        t = text(n)
        grams, ranks = langid.top_ranks(t, (1, 2, 3), 50)
        away = {lang: sum(abs(r.index(int(g)) - k) if int(g) in r else 50 for g, k in zip(grams, ranks)) for lang, r in ranked.items()}
        best = min(sorted(away), key=away.get)
        assert profiles.predict(t) == (best, 1 - away[best] / (50 * len(grams)))
