"""op1, op2, op4, op6: brute force, round trips and held-out accuracy; odd rows."""

import collections
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfline.llm import langid, lm, sentencepiece, toxicity
from shelfline.llm.words import buffers, hashes, spans, LOWER

SF = "/root/testdata/sf0.001"


def _tokens(text):
    return [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().translate(LOWER.tobytes())) if w] + [None]


def test_word_hashes_equal_only_for_equal_words():
    texts = ["a b  ab\tAB", None, "", "x" * 300_000 + " y", "b a"]
    raw, off = buffers(pa.array(texts))
    low = LOWER[raw]
    s, e, n = spans(low, off)
    assert n.tolist() == [4, 0, 0, 2, 2]
    words = [low[i:j].tobytes() for i, j in zip(s, e)]
    h = hashes(low, s, e)[0].tolist()
    assert len(set(h)) == len(set(words)) and all((h[i] == h[j]) == (words[i] == words[j])
                                                  for i in range(len(h)) for j in range(len(h)))


def test_language_model_against_brute_force(spark, odd_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    train = [t for i, t in rows if i is None or i % 3]
    model = lm.fit(docs.filter("doc_id is null or doc_id % 3 <> 0"), shard_bytes=50_000)
    uni, pairs = collections.Counter(), collections.Counter()
    for t in train:
        w = _tokens(t)
        uni.update(w)
        pairs.update(zip(["begin"] + w[:-1], w))
    total, v = sum(uni.values()), len(uni)
    assert (model.total, model.vocabulary, model.pairs) == (total, v, len(pairs))
    cont, kinds, ctx = collections.Counter(w for _, w in pairs), collections.defaultdict(collections.Counter), collections.Counter()
    for (a, _), c in pairs.items():
        kinds[a][min(c, 3)] += 1
        ctx[a] += c

    rest = sum(model.d1[min(c, 3)] for c in cont.values()) / len(pairs)

    def p1(w):
        return max(cont[w] - model.d1[min(cont[w], 3)], 0) / len(pairs) + rest / (v + 1)

    spare = {}

    def p(a, w):
        if not ctx[a]:
            return p1(w)
        c = pairs[a, w]
        keep = sum(model.d2[k] * n for k, n in kinds[a].items())
        if w not in spare:
            spare[w] = p1(w)
        return max(c - model.d2[min(c, 3)], 0) / ctx[a] + keep / ctx[a] * spare[w]

    got = {(r.doc_id, r.n_tokens): r for r in lm.score(docs, model).collect()}
    for i, t in rows:
        w = _tokens(t)
        r = got[i, len(w)]
        assert r.n_known == sum(uni[x] > 0 for x in w)
        assert r.base_score == pytest.approx(sum(math.log10((uni[x] + .5) / (total + .5 * (v + 1))) for x in w), rel=1e-9)
        assert r.score == pytest.approx(sum(math.log10(p(a, x)) for a, x in zip(["begin"] + w[:-1], w)), rel=1e-9)
    assert sum(p("the", w) for w in uni) + p("the", "not a word") == pytest.approx(1.0)


def test_language_model_without_training(spark, odd_docs, no_docs):
    model = lm.fit(no_docs)
    assert (model.total, model.vocabulary) == (0, 0)
    assert lm.score(odd_docs.select("doc_id", "text"), model).count() == odd_docs.count()
    assert lm.score(no_docs, lm.fit(odd_docs)).count() == 0


def test_language_id(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.pmod("doc_id", F.lit(5)) == 0
    prototypes = langid.learn(docs.filter(~held))
    got = langid.predict(docs.filter(held).select("doc_id", F.col("lang").alias("truth"), "text"), prototypes).collect()
    assert np.mean([r.truth == r.lang_pred for r in got]) > 0.95
    odd = langid.predict(odd_docs.select("doc_id", "id", "text"), prototypes).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert {r.lang_pred for r in odd if r.doc_id in (3, 4, 8)} == {"und"}
    assert langid.predict(no_docs, prototypes).count() == 0
    assert langid.learn(no_docs) == {}
    assert {r.lang_pred for r in langid.predict(odd_docs, {}).collect()} == {"und"}


def test_profile_is_the_bundle_of_bound_letters():
    codes = langid.grams("Ab, b")
    one = {c: langid.vectors(np.array([c], np.uint64))[0].astype(int) for c in codes.tolist()}
    assert [len(codes), len(one)] == [4, 4]  # gap-a-b is a gram; so are a-b-gap, b-gap-b, gap-b-gap
    assert np.array_equal(langid._bundle(["Ab, b"], langid.DIMS, langid.ORDER)[0], sum(one.values()))


def test_language_id_by_hand(spark):
    """Letters bound, bundled and compared in plain integers."""
    texts = [("en", "The cat sat, on the mat!"), ("en", "a dog and the cat"), ("fr", "Le chat est sur l'été"), ("fr", "un chien noir"),
             ("de", "Der Hund und die Katze"), (None, "the chat"), ("de", None), ("en", "12 + 3"), ("fr", "x")]
    letter = lambda c: langid.vectors(np.array([c], np.uint64), order=1)[0].astype(int)

    def profile(text):
        seq = [0]
        for ch in (text or "").lower():
            c = ord(ch) if ch.isalpha() else 0
            seq += [c] if c or seq[-1] else []
        if not any(seq):
            return np.zeros(langid.DIMS, int)
        seq += [0] if seq[-1] else []
        seq += [0] * (3 - len(seq))
        return sum(np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c) for a, b, c in zip(seq, seq[1:], seq[2:]))
    docs = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc_id int, lang string, text string")
    base = {k: sum(profile(t) for lang, t in texts if lang == k) for k in ("de", "en", "fr")}
    learned = langid.learn(docs)
    assert {k: v.tolist() for k, v in learned.items()} == {k: v.tolist() for k, v in base.items()}
    for r in langid.predict(docs.select("doc_id", "text"), learned).collect():
        p = profile(texts[r.doc_id][1])
        if not p.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cos = {k: float(p @ v) / (np.linalg.norm(p) * np.linalg.norm(v)) for k, v in base.items()}
        best = max(sorted(cos), key=cos.get)
        assert r.lang_pred == best and abs(r.score - max(cos[best], 0)) < 1e-6


def test_sentencepiece(spark, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text")
    extra = spark.createDataFrame([(90, "  a  b   "), (91, "x▁y z▁"), (92, "日本 \U0001f642\tq\n\n r"), (93, " " * 7),
                                   (94, "\x00<s> </s><unk><0x41>")], "doc_id bigint, text string")
    docs = docs.unionByName(extra)
    rows = sentencepiece.encode(docs).collect()
    assert len(rows) == docs.count()
    reference = sentencepiece.Codec(sentencepiece._model(sentencepiece.MODEL)).reference
    text = collections.defaultdict(list)
    for r in docs.collect():
        text[r.doc_id].append(r.text)
    for r in rows:
        t = text[r.doc_id][0]
        assert r.n_differ == 0
        if t is None:
            assert r.token_ids is None and r.n_tokens == 0 and r.roundtrip is None
        else:
            assert r.token_ids == reference.encode(t) and r.n_tokens == len(r.token_ids) and r.roundtrip
    back = {r.doc_id: r.text for r in sentencepiece.decode(sentencepiece.encode(docs)).collect()}
    for i, t in text.items():
        assert back[i] == (t[0].replace("▁", " ") if t[0] else t[0])
    assert sentencepiece.encode(no_docs).count() == 0


def _plain(bits):
    def field(n, kind, value):
        return bytes([n << 3 | kind]) + (value if kind else bytes([value]))
    import struct
    out = b""
    for piece, score, type_ in bits:
        p = piece.encode()
        body = bytes([0x0A, len(p)]) + p + b"\x15" + struct.pack("<f", score) + bytes([0x18, type_])
        out += bytes([0x0A, len(body)]) + body
    return out


def test_sentencepiece_unigram_parity():
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1),
              ("ab", -3.1, 1), ("▁ab", -4.0, 1), ("ba", -3.0, 1), ("▁b", -3.3, 1)]
    data = _plain(pieces) + bytes([0x12, 2, 0x18, 1])  # trainer: unigram
    codec = sentencepiece.Codec(data)
    assert codec.spec.kind == "unigram"
    texts = ["ab ba", "abab", "b", "", "ba ab b a", "aab  b"]
    ids, per, differ, same = codec.encode(texts)
    want = [codec.reference.encode(t) for t in texts]
    assert per.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert differ.sum() == 0


def test_sentencepiece_long_texts_in_segments(monkeypatch):
    monkeypatch.setattr(sentencepiece, "SEGMENT", 40)
    codec = sentencepiece.Codec(sentencepiece._model(sentencepiece.MODEL))
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("ab  é▁\n🙂c "), 400)) for _ in range(60)] + [" ", "x" * 300, " ".join(["word"] * 200) + " "]
    assert max(len(codec.segments(t)) for t in texts) > 5
    ids, per, differ, same = codec.encode(texts)
    want = [codec.reference.encode(t) for t in texts]
    assert per.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert not differ.any() and same.all()


def test_sentencepiece_memory_of_a_batch():
    """Beside its results a batch takes few bytes per byte of text: no list of ints per library, no 8-byte position per byte."""
    import tracemalloc
    codec = sentencepiece.Codec(sentencepiece._model(sentencepiece.MODEL))
    rng = np.random.default_rng(5)
    texts = [" ".join("".join(rng.choice(list("etaoinshré"), rng.integers(2, 9))) for _ in range(600)) for _ in range(150)]
    codec.encode(texts[:1])
    tracemalloc.start()
    codec.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * sum(len(t.encode()) for t in texts)


def test_sentencepiece_a_wrong_rebuild_shows():
    from tokenizers import normalizers
    codec = sentencepiece.Codec(sentencepiece._model(sentencepiece.MODEL))
    texts = ["the quick brown fox jumps over the lazy dog", "", "another line of text"]
    assert codec.encode(texts)[2].tolist() == [0, 0, 0]
    codec.spec.scores = codec.spec.scores[::-1]  # merges in the wrong order
    codec.tokenizer = sentencepiece.build(codec.spec)
    ids, per, differ, _ = codec.encode(texts)
    assert differ[0] == 1 and differ[1] == 0
    assert ids.tolist() != [i for t in texts for i in codec.reference.encode(t)]  # the backend's own ids
    codec = sentencepiece.Codec(sentencepiece._model(sentencepiece.MODEL))
    assert [codec.normaliser.normalize_str(t) for t in texts if t] == [codec.normalise(t) for t in texts if t]
    codec.plain, codec.normaliser = False, normalizers.Replace(" ", sentencepiece.MARK)  # and one that forgets the dummy prefix
    assert codec.encode(texts)[2].tolist() == [1, 0, 1]
    ids = codec.encode(texts[:1])[0]
    size = np.array([len(ids), len(ids), 0])
    lost = codec._lost(np.concatenate([ids, ids]), size, [codec.normalise(texts[0]), codec.normalise(texts[0])[:-1] + "?", "x"])
    assert lost.tolist() == [False, True, True]


def test_clashing_columns(spark, odd_docs):
    """Output columns take the place of columns of their name."""
    clash = odd_docs.selectExpr("*", "'x' as n_tokens", "1 as token_ids", "2 as score", "3 as lang_pred", "4 as p_toxic")
    got = sentencepiece.encode(clash)
    assert got.columns.count("n_tokens") == 1 and got.schema["n_tokens"].dataType.simpleString() == "bigint"
    assert {"lang", "source", "score"} <= set(got.columns) and got.count() == clash.count()
    got = langid.predict(clash, langid.learn(clash.select("text", "lang")))
    assert got.columns.count("score") == got.columns.count("lang_pred") == 1 and got.count() == clash.count()
    none = toxicity.fit(clash, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    got = toxicity.classify(clash, none)
    assert got.columns.count("p_toxic") == 1 and got.schema["p_toxic"].dataType.simpleString() == "double"


def test_toxicity_chain_against_a_plain_one(spark):
    """The same links, fitted one by one on a plain table with out-of-fold probabilities."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector, vector_to_array
    rng = np.random.default_rng(1)
    rows = []
    for i in range(160):
        bad, junk = rng.random() < 0.4, rng.random() < 0.3
        words = [*rng.choice(["apple", "pear", "plum", "fig", "grapes"], 3), *["nastyword"] * int(bad or rng.random() < 0.1), *["zzz"] * int(junk)]
        rows.append((i, " ".join(words), int(not junk), int(bad and not junk or rng.random() < 0.05)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, quality int, toxic int")
    chain = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "quality", "toxic"), folds=2, iterations=20, max_features=6)
    size = len(chain.known)

    def seen(text):  # features of a text by their definition: words and their first 4, 5 and 6 bytes
        out = set()
        for w in set(text.split()):
            for h in [toxicity.features(pa.array([w]))[1]]:
                out |= set(h.tolist())
        return [float(k in out) for k in chain.known.tolist()]
    table = spark.createDataFrame([(i, seen(t), float(q), float(x)) for i, t, q, x in rows], "id bigint, f array<double>, y0 double, y1 double")
    table = table.withColumn("fold", F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("fold")), F.lit(2))).cache()
    regression = lambda y: LogisticRegression(featuresCol="x", labelCol=y, regParam=5e-5, elasticNetParam=1.0,
                                              standardization=False, maxIter=20)
    wide = lambda df, p: df.withColumn("x", array_to_vector(F.concat("f", F.array(p, F.lit(0.0)))))
    first = wide(table, F.lit(0.0))
    parts = [regression("y0").fit(first.filter(F.col("fold") != k)).transform(first.filter(F.col("fold") == k))
             .select("id", "f", "y0", "y1", vector_to_array("probability")[1].alias("p")) for k in range(2)]
    second = wide(parts[0].unionByName(parts[1]), F.col("p"))
    one, two = regression("y0").fit(first), regression("y1").fit(second)
    for (intercept, w), plain in zip(chain.links, (one, two)):
        assert abs(intercept - plain.intercept) < 0.05 and np.allclose(w, plain.coefficients.toArray(), atol=0.05)
    assert abs(chain.links[1][1][size]) > 0.01  # the second link uses the first's probability
    for r in toxicity.classify(docs.select("doc_id", "text"), chain).collect():
        x, p = np.array([*seen(r.text), 0.0, 0.0]), []
        for k, (intercept, w) in enumerate(chain.links):
            p.append(1 / (1 + np.exp(-(intercept + x @ w))))
            x[size + k] = p[-1]
        assert np.allclose([r.p_quality, r.p_toxic], p)


def test_toxicity_chain(spark, odd_docs, no_docs):
    rng = np.random.default_rng(0)
    words = [f"w{a}{b}" for a in "abcdefgh" for b in "ijklmnop"]
    rows, labels = [], []
    for i in range(400):
        t = list(rng.choice(words, 30))
        toxic, junk = i % 5 == 0, i % 4 == 0
        t += ["vileword"] * toxic + ["$$ zzjunk"] * junk
        rows.append((i, " ".join(rng.permutation(t))))
        labels.append((i, int(not junk), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    y = spark.createDataFrame(labels + [(7, None, 1), (None, 1, 1), (9999, 1, 1)], "doc_id bigint, quality int, toxic int")
    known = y.filter("doc_id % 2 = 0 or doc_id is null or doc_id = 9999")
    chain = toxicity.fit(docs, known, iterations=12, folds=2)
    got = {r.doc_id: r for r in toxicity.classify(docs, chain).collect()}
    held = [i for i in range(400) if i % 2]
    assert np.mean([(got[i].p_toxic >= toxicity.THRESHOLD) == bool(labels[i][2]) for i in held]) > 0.97
    assert np.mean([(got[i].p_quality >= 0.5) == bool(labels[i][1]) for i in held]) > 0.95
    kept = toxicity.reject(docs, known, iterations=12, folds=2)
    assert kept.columns == docs.columns and 300 <= kept.count() <= 330
    assert toxicity.classify(odd_docs, chain).count() == odd_docs.count()
    assert toxicity.classify(no_docs, chain).count() == 0
    # without labels, or with one class, every text gets the labels' share
    none = toxicity.fit(docs, y.limit(0))
    assert max(r.p_toxic for r in toxicity.classify(odd_docs, none).collect()) < 1e-100
    ones = toxicity.fit(docs, y.filter("toxic = 1"), categories=("toxic",))
    assert min(r.p_toxic for r in toxicity.classify(odd_docs, ones).collect()) > 0.99
