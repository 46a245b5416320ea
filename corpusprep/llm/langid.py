"""Language ID: nearest of several clustered centroids per language.

Texts become hashed byte 3-gram counts of the lower-cased text, log-scaled, weighted by inverse
document frequency and normalised. Spherical k-means clusters the sample of every language into a few
centroids. A text takes the language of the centroid with the largest cosine; it is rejected when it
is farther from that centroid than nearly all training excerpts of its length, with some slack. Short
texts are far from all centroids in any language: the accepted distance is learned for each of SIZES
from excerpts of so many 3-grams, and a text goes by the largest size that it reaches. Every text with a
letter reaches the first.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import col, for_workers, private, refuse  # noqa: F401

DIM = 4096
MAX_LANGUAGES = 256  # default of fit's parameter
NONE = "und"
SIZES = (1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1024)  # 3-grams
NEAR = 0.995  # share of the training excerpts within the radius before slack
FEW = 200  # a centroid with fewer excerpts of a size takes those of its language
_LETTER = re.compile(r"[^\W\d_]")  # letters, and numbers that are no digits
_PIECE = 1 << 22
# ASCII letters are lower-cased, all other ASCII is a space: signs and digits tell no language
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


@dataclass(frozen=True)
class Model:
    """At most max_languages * k centroids of DIM floats: small enough to go with every task."""

    langs: list[str]
    centroids: np.ndarray  # rows normalised
    radius: np.ndarray  # largest accepted distance (1 - cosine) of each centroid by SIZES
    idf: np.ndarray


def _grams(piece: str) -> np.ndarray:
    data = b" " + b" ".join(piece.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "
    a = np.frombuffer(data, np.uint8).astype(np.uint32)
    return (a[:-2] * np.uint32(0x9E3779B1) + a[1:-1] * np.uint32(0x85EBCA6B) + a[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(20)


def _pieces(text: str):
    for at in range(0, len(text), _PIECE):
        yield _grams(text[max(0, at - 2):at + _PIECE])


def counts(text: str | None) -> np.ndarray:
    """Hashed byte 3-gram counts; a space stands before and after the text and for all between words."""
    out = np.zeros(DIM, dtype=np.float32)
    for grams in _pieces(text or ""):
        out += np.bincount(grams, minlength=DIM).astype(np.float32)
    return out


def excerpts(text: str) -> np.ndarray:
    """The hashed 3-grams of one excerpt of each of SIZES that the text reaches, one after the other. Where in the
    whole text they stand goes by its checksum."""
    h = np.concatenate([g.astype(np.uint16) for g in _pieces(text)])
    at = zlib.crc32(h.tobytes())
    return np.concatenate([h[:0], *[h[at % (len(h) - n + 1):][:n] for n in SIZES if n <= len(h)]])


def radii(x: np.ndarray, c: np.ndarray, parts: list[np.ndarray], idf: np.ndarray, slack: float) -> np.ndarray:
    """The accepted distance from each centroid by SIZES, from the members' excerpts. A size without any
    goes by the next smaller one, else by the next larger one, else by the whole members."""
    def near(y):
        sims = y @ c.T
        label, dist = np.argmax(sims, axis=1), 1 - np.clip(sims.max(axis=1), 0, 1)
        few = [dist[label == j] if (label == j).sum() >= FEW else dist for j in range(len(c))]
        d = np.array([np.quantile(f, NEAR, method="lower") for f in few])
        return np.minimum(d * (1 + slack), d + slack * (1 - d))

    out, start = [], 0
    for n in SIZES:
        some = [np.bincount(e[start:start + n], minlength=DIM) for e in parts if len(e) > start]
        out.append(near(weighted(np.stack(some).astype(np.float32), idf)) if some else None)
        start += n
    known = next((r for r in out if r is not None), None)
    if known is None:
        known = near(x)
    for i, r in enumerate(out):
        known = out[i] = known if r is None else r
    return np.stack(out, axis=1).astype(np.float64)


def weighted(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(tf) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm == 0, 1, norm)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, least: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids and members' labels. It starts from members at even quantiles of
    the cosine to the mean, so no outlier becomes a cluster; clusters with less than ``least`` of the
    members are given up."""
    order = np.argsort(x @ x.mean(axis=0), kind="stable")
    k = min(k, len(x))
    c = x[order[((np.arange(k) + 0.5) * len(x) / k).astype(int)]]
    for _ in range(rounds):
        label = np.argmax(x @ c.T, axis=1)
        new = np.stack([x[label == j].mean(axis=0) if (label == j).any() else c[j] for j in range(len(c))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-9)
        if np.allclose(new, c, atol=1e-5):
            break
        c = new
    label = np.argmax(x @ c.T, axis=1)
    size = np.bincount(label, minlength=len(c))
    c = c[size >= min(size.max(), least * len(x))]
    return c.astype(np.float32), np.argmax(x @ c.T, axis=1)


def has_letter(text: str | None) -> bool:
    """Whether some character is of Unicode category L (str.isalpha)."""
    return bool(text) and any(m[0].isalpha() for m in _LETTER.finditer(text))


def _count_batches(batches):
    for b in batches:
        rows = [(lang.as_py(), counts(t.as_py()), excerpts(t.as_py())) for lang, t in zip(b.column(0), b.column(1), strict=True) if has_letter(t.as_py())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), *[pa.array([r[i].tobytes() for r in rows], pa.binary()) for i in (1, 2)]], names=["lang", "tf", "parts"])


def _cluster(idf: np.ndarray, k: int, slack: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(zip(group["tf"], group["parts"], strict=True))
        x = weighted(np.stack([np.frombuffer(t, np.float32) for t, _ in rows]), idf)
        c, _ = kmeans(x, k)
        radius = radii(x, c, [np.frombuffer(e, np.uint16) for _, e in rows], idf, slack)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "part": range(len(c)), "centroid": [r.tobytes() for r in c], "radius": [r.tobytes() for r in radius]})

    return run


def fit(docs: DataFrame, per_language: int = 400, k: int = 4, slack: float = 0.25, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang", max_languages: int = MAX_LANGUAGES) -> Model:
    """Learn from a sample of at most ``per_language`` different texts a language (those with the smallest hash
    of id and text), for the ``max_languages`` most frequent languages (ties by name); texts of the others teach
    nothing.

    Rows with a null language or a text without letters teach nothing; ids may be null or repeat; no rows
    give an empty model.
    """
    spark = docs.sparkSession
    for_workers(spark)
    text = col(text_col).cast("string")
    rank = F.xxhash64(F.lit("sample"), F.coalesce(col(id_col).cast("string"), F.lit("")), text)
    rows = docs.filter(col(lang_col).isNotNull() & text.isNotNull()).select(col(lang_col).cast("string").alias("lang"), text.alias("text"), rank.alias("rank"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("rank").alias("different")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    if not sizes:
        return Model([], np.zeros((0, DIM), np.float32), np.zeros((0, len(SIZES))), np.ones(DIM, np.float32))
    # a cut of the hash range by language leaves about twice the sample: no task sorts a whole language; copies meet before the shuffle
    share = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, (2 * per_language + 100) / max(1, r["different"])) * 2.0**64))])
    some = rows.filter(F.col("rank").cast("double") + 2.0**63 <= share[F.col("lang")])
    some = some.groupBy("lang", "rank").agg(F.min("text").alias("text"))
    ordered = some.withColumn("n", F.row_number().over(_by_lang())).filter(F.col("n") <= per_language)
    sample = ordered.select("lang", "text").mapInArrow(_count_batches, "lang string, tf binary, parts binary").persist()
    seen, n = np.zeros(DIM), 0
    for r in sample.mapInArrow(_frequencies, "n long, df binary").toLocalIterator():  # one row a task, 4 kB each
        seen, n = seen + np.frombuffer(r["df"], np.float64), n + r["n"]
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)
    parts = sample.groupBy("lang").applyInPandas(_cluster(idf, k, slack), "lang string, part int, centroid binary, radius binary")
    found = sorted(parts.collect(), key=lambda r: (r["lang"], r["part"]))
    sample.unpersist()
    if not found:
        return Model([], np.zeros((0, DIM), np.float32), np.zeros((0, len(SIZES))), idf)
    return Model([r["lang"] for r in found], np.stack([np.frombuffer(r["centroid"], np.float32) for r in found]),
                 np.stack([np.frombuffer(r["radius"], np.float64) for r in found]), idf)


def _by_lang():
    from pyspark.sql import Window

    return Window.partitionBy("lang").orderBy("rank")


def _frequencies(batches):
    seen, n = np.zeros(DIM), 0
    for b in batches:
        for t in b.column(1):
            seen += np.frombuffer(t.as_py(), np.float32) > 0
            n += 1
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([seen.tobytes()], pa.binary())], names=["n", "df"])


def _predict_batches(model: Model, text_at: int, step: int = 256):
    langs = np.array([*model.langs, NONE], dtype=object)

    def run(batches):
        for b in batches:
            pred, score, rejected = [], [], []
            for at in range(0, b.num_rows, step):
                texts = b.column(text_at).slice(at, step).to_pylist()
                ok = np.array([has_letter(t) for t in texts])
                if not model.langs:
                    ok[:] = False
                best, cos = np.full(len(texts), len(model.langs)), np.zeros(len(texts))
                far = np.ones(len(texts), dtype=bool)
                if ok.any():
                    tf = np.stack([counts(t) for t, o in zip(texts, ok, strict=True) if o])
                    sims = weighted(tf, model.idf) @ model.centroids.T
                    best[ok], cos[ok] = np.argmax(sims, axis=1), np.clip(sims.max(axis=1), 0, 1)
                    size = np.searchsorted(SIZES, tf.sum(axis=1), side="right") - 1
                    far[ok] = 1 - cos[ok] > model.radius[best[ok], size] + 1e-6
                pred += list(langs[best])
                score += [round(float(c), 6) for c in cos]
                rejected += far.tolist()
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[f"c{i}" for i in range(b.num_columns + 3)])

    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """docs with the nearest language (``und`` for null, for texts without a letter and for an empty
    model), its cosine (0 to 1) and whether the text is rejected (``und``, or too far for its
    length). A column of docs named like one of ``names`` is an error."""
    from pyspark.sql import types as T

    refuse(docs, *names)
    for_workers(docs.sparkSession)
    nullable = [T.StructField(f.name, f.dataType, True) for f in docs.schema.fields]
    schema = T.StructType([*nullable, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.BooleanType())])
    return docs.mapInArrow(_predict_batches(model, docs.columns.index(text_col)), schema)


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, mod 4: fold 2 is held out. A null id counts as empty text."""
    return F.crc32(F.coalesce(col(id_col).cast("string"), F.lit(""))) % 4


def fold_of(doc_id) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 4
