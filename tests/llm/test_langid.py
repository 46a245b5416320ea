import math
import zlib

import numpy as np
import pytest

from corpusprep.llm import langid


def test_held_out_accuracy_and_rejection(spark):
    from corpusprep.llm.registry import op7_language_id

    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op7_language_id(spark, sf).collect()
    assert len(rows) == len(lang) and all(r["held_out"] == (langid.fold_of(r["doc_id"]) == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]] is not None]
    right = sum(r["lang_pred"] == lang[r["doc_id"]] for r in held)
    assert right / len(held) > 0.97, right / len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) / len(rows) < 0.02


def test_edges(spark):
    train = spark.createDataFrame([(i, "the cat sat on the mat and then " * 6, "en") for i in range(8)] + [(20 + i, "der hund und die katze sind hier " * 6, "de") for i in range(8)]
                                  + [(50, None, "en"), (51, "", "fr"), (52, "123", "fr"), (53, "no language here", None), (None, "the dog", "en")], "doc_id long, text string, lang string")
    model = langid.fit(train)
    assert set(model.langs) == {"en", "de"}
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "12 ...", "x"), (4, "the cat and the mat", "x"), (5, "die katze und der hund", "x"), (5, "die katze und der hund", "x"),
                                  (6, "zzzzqqqq xxxx " * 20, "x"), (7, "zzqq", "x"), (None, "the cat " * 100_000, "x")], "doc_id long, text string, score string")
    rows = langid.predict(docs, model, names=("p", "s", "r")).collect()
    assert [r["p"] for r in rows] == ["und", "und", "und", "en", "de", "de", rows[6]["p"], rows[7]["p"], "en"]
    assert [r["r"] for r in rows[:3]] == [True] * 3 and rows[6]["r"] and rows[7]["r"]
    none = langid.fit(train.limit(0))
    assert {r["p"] for r in langid.predict(docs, none, names=("p", "s", "r")).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model, names=("p", "s", "r")).count() == 0


def test_long_texts_in_pieces(monkeypatch):
    text = "abc déf " * 50
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "_PIECE", 64)
    assert abs(langid.counts(text).sum() - whole.sum()) < 60 and np.count_nonzero(whole) > 5


def _english(i, n):
    words = "the of and to in is that for it with as was on be by this have from or had not are but what all were when we there can an your which their said if do will each about how".split()
    rng = np.random.default_rng(i)
    return " ".join(rng.choice(words, n))


def test_short_texts_have_a_wider_but_finite_radius(spark):
    rows = [(i, _english(i, 80), "en") for i in range(200)]
    docs = spark.createDataFrame([(0, "zzqx vvkj qqxz jjwv kkzq xxvq"), (1, "zzqx vvkj qqxz " * 4), *[(10 + i, _english(1000 + i, 4 + i % 20)) for i in range(60)]], "doc_id long, text string")
    for train in (rows, [*rows, (900, "zzqx vvkj qqxz jjwv kkzq xxvq " * 8, "en")], [(i, " ".join(t.split()[:25]), lang) for i, t, lang in rows]):
        model = langid.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
        assert (model.radius < 0.99).all() and (model.radius[:, 0] > model.radius[:, 3]).all()
        got = {r["doc_id"]: r["rejected"] for r in langid.predict(docs, model).collect()}
        assert got[0] and got[1] and sum(got[10 + i] for i in range(60)) <= 2


def test_letters_are_category_l(spark):
    assert not any(langid.has_letter(t) for t in (None, "", "½ ² ① Ⅷ 12", "٣", "_-!"))
    assert all(langid.has_letter(t) for t in ("a", "1é", "½ß", "字", "ʰ", "9 " * 1000 + "x"))


def test_null_and_repeated_ids_teach(spark):
    rows = [(None, _english(i, 60), "en") for i in range(300)] + [(7, "der hund und die katze sind hier " + str(i) * 3 + " und dort " * (1 + i % 5), "de") for i in range(300)]
    rows += [(8, "le chat est sur la table et il dort " * 3, "fr")] * 2000  # copies: one text
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5))
    assert set(model.langs) == {"en", "de", "fr"}
    docs = spark.createDataFrame([(1, "the of and to in is that for it with", "x"), (2, "die katze und der hund sind dort", "x"), (3, "le chat et la table", "x")], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in langid.predict(docs, model).orderBy("doc_id").collect()] == ["en", "de", "fr"]
    few = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_languages=1)
    assert set(few.langs) == {"fr"}  # the most frequent one


def test_one_word_texts_have_a_learned_radius(spark):
    rows = [(i, _english(i, 80), "en") for i in range(300)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    words = ["the", "of", "with", "have", "which", "about", "their", "there"]
    unseen = next(c for c in "qzxjkvw" if not model.centroids[:, langid._grams(c)].any())  # no collision of hashes
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(words)] + [(100, "zq"), (101, "xxkjq"), (102, unseen)], "doc_id long, text string")
    got = {r["doc_id"]: r["rejected"] for r in langid.predict(docs, model).collect()}
    assert not any(got[i] for i in range(len(words))) and got[100] and got[101] and got[102]


def test_clashing_names_are_refused(spark):
    model = langid.Model([], np.zeros((0, langid.DIM), np.float32), np.zeros((0, len(langid.SIZES))), np.ones(langid.DIM, np.float32))
    with pytest.raises(ValueError):
        langid.predict(spark.createDataFrame([(1, "a", 0.5)], "doc_id long, text string, Score double"), model)


# -- an independent twin in plain Python ------------------------------------------------------------
def _plain_grams(text):
    """Hashed 3-grams of the bytes, by the definition: letters lower-cased, everything else one space."""
    data = bytes(b if 97 <= b <= 122 or b > 127 else 32 for b in text.lower().encode())
    data = b" " + b" ".join(data.split()) + b" "
    return [((data[i] * 0x9E3779B1 + data[i + 1] * 0x85EBCA6B + data[i + 2] * 0xC2B2AE35) % 2**32) >> 20 for i in range(len(data) - 2)]


def _plain_vector(grams, idf):
    tf = {}
    for g in grams:
        tf[g] = tf.get(g, 0) + 1
    x = {g: math.log1p(n) * idf[g] for g, n in tf.items()}
    norm = math.sqrt(sum(v * v for v in x.values()))
    return {g: v / norm for g, v in x.items()}


def _plain_dot(x, y):
    return sum(v * y.get(g, 0.0) for g, v in x.items())


def _plain_kmeans(rows, k, rounds=12, least=0.02):
    """Spherical k-means on sparse dicts, started from even quantiles of the cosine to the mean."""
    def mean(some):
        out = {}
        for x in some:
            for g, v in x.items():
                out[g] = out.get(g, 0.0) + v / len(some)
        return out

    middle = mean(rows)
    order = sorted(range(len(rows)), key=lambda i: _plain_dot(rows[i], middle))
    k = min(k, len(rows))
    centroids = [rows[order[int((j + 0.5) * len(rows) / k)]] for j in range(k)]
    for _ in range(rounds):
        label = [max(range(len(centroids)), key=lambda j: (_plain_dot(x, centroids[j]), -j)) for x in rows]
        new = []
        for j, c in enumerate(centroids):
            some = [x for x, y in zip(rows, label) if y == j]
            c = mean(some) if some else c
            norm = math.sqrt(sum(v * v for v in c.values()))
            new.append({g: v / norm for g, v in c.items()})
        moved = max(abs(a.get(g, 0.0) - b.get(g, 0.0)) for a, b in zip(new, centroids) for g in {*a, *b})
        if moved < 1e-5:
            break
        centroids = new
    label = [max(range(len(centroids)), key=lambda j: (_plain_dot(x, centroids[j]), -j)) for x in rows]
    size = [label.count(j) for j in range(len(centroids))]
    return [c for c, n in zip(centroids, size) if n >= min(max(size), least * len(rows))]


def test_model_and_predictions_against_a_plain_twin(spark):
    """Sample, document frequencies, clusters, cosines and radii, recomputed without numpy on a small table."""
    german = "der die und das ist nicht mit von auf ein eine als auch nach wie aus bei hat nur noch wird sind einer um am".split()
    rng = np.random.default_rng(3)
    rows = [(i, _english(i, 12 + i % 9), "en") for i in range(40)] + [(100 + i, " ".join(rng.choice(german, 10 + i % 8)), "de") for i in range(36)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), k=3)
    texts = {lang: sorted({t for _, t, x in rows if x == lang}) for lang in ("de", "en")}
    everything = [t for some in texts.values() for t in some]
    seen = [0] * langid.DIM
    for t in everything:
        for g in set(_plain_grams(t)):
            seen[g] += 1
    idf = [math.log((1 + len(everything)) / (1 + s)) + 1 for s in seen]
    assert np.allclose(model.idf, idf, atol=1e-5)
    found = {}
    for lang, some in texts.items():
        vectors = {t: _plain_vector(_plain_grams(t), idf) for t in some}
        clusters = _plain_kmeans(list(vectors.values()), 3)
        at = [i for i, x in enumerate(model.langs) if x == lang]
        assert len(clusters) == len(at)
        # the same partition of the members, whatever the order of equal starts
        ours = {frozenset(t for t in some if max(at, key=lambda i: _plain_dot(vectors[t], dict(enumerate(model.centroids[i].tolist())))) == i) for i in at}
        theirs = {frozenset(t for t in some if max(range(len(clusters)), key=lambda j: _plain_dot(vectors[t], clusters[j])) == j) for j in range(len(clusters))}
        assert ours == theirs
        for i in at:
            assert min(max(abs(c.get(g, 0.0) - model.centroids[i][g]) for g in range(langid.DIM)) for c in clusters) < 1e-3
        # the radius for excerpts of four 3-grams: a high quantile of their distances, with slack
        size = langid.SIZES.index(4)
        dist = []
        for t in some:
            grams = _plain_grams(t)
            start = zlib.crc32(np.array(grams, np.uint16).tobytes()) % (len(grams) - 4 + 1)
            x = _plain_vector(grams[start:start + 4], idf)
            dist.append(1 - max(_plain_dot(x, c) for c in clusters))
        d = sorted(dist)[int(math.floor((len(dist) - 1) * langid.NEAR))]
        assert all(abs(model.radius[i][size] - min(d * 1.25, d + 0.25 * (1 - d))) < 1e-4 for i in at)
        found[lang] = clusters
    docs = [(i, t) for i, t in enumerate(["the which of their", "wie nach aus", "zzz qqq", "und", "die there", "not ist mit you"])]
    for r in langid.predict(spark.createDataFrame(docs, "doc_id long, text string"), model).collect():
        x = _plain_vector(_plain_grams(docs[r["doc_id"]][1]), idf)
        cos = {lang: max(_plain_dot(x, c) for c in some) for lang, some in found.items()}
        assert r["lang_pred"] == max(cos, key=cos.get) and abs(r["score"] - max(cos.values())) < 1e-4
