"""Language identification by rank-order n-gram profiles.

A language's profile lists its most frequent letter n-grams (one to three, words padded with blanks) by rank.  A
document's own most frequent n-grams are ranked the same way, and each profile is charged the out-of-place
distance: how far each n-gram's rank is from its rank in the profile, ``size`` where the profile lacks it.  The
nearest profile names the language; equal distances go to the smaller name.

Profiles are fitted on at most about ``per_language`` labelled documents of each language, those with the smallest
digests of id (a bound on training rows only).  Every text is read whole and judged within one task; profiles
(``size`` n-grams of each language) are what is broadcast.

Edge cases: a null text or one without letters is ``und`` with score 0; no labelled rows make everything ``und``;
repeated rows get equal answers; columns that clash with the result's names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.llm import _text as tx

UNKNOWN = "und"
SIZE = 300
PER_LANGUAGE = 1500
_BITS = np.uint64(21)


@lru_cache(1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, packed 21 bits a character, and their counts; blanks are 0."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_in = letters()[c]
    if not is_in.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keep = is_in.copy()
    keep[1:] |= is_in[:-1]  # one blank after each word
    c = np.concatenate(([0], np.where(is_in, c, 0)[keep], [0])).astype(np.uint64)
    if not c[-2]:
        c = c[:-1]
    one, two = c[c > 0], (c[:-1] << _BITS) | c[1:]
    three = ((c[:-2] << (_BITS + _BITS)) | (c[1:-1] << _BITS) | c[2:])[c[1:-1] > 0]
    return np.unique(np.concatenate((one, two, three)), return_counts=True)


def top(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams in order of rank; ties by code."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        some = counts >= least
        codes, counts = codes[some], counts[some]
    return codes[np.argsort(-counts, kind="stable")][:size]


def _counting(batches) -> Iterator:
    import pyarrow as pa

    sums: dict[str, dict[int, int]] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = sums.setdefault(lang, {})
            for code, n in zip(*(x.tolist() for x in grams(text))):
                own[code] = own.get(code, 0) + n
    for lang, own in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.int64()), pa.array(list(own.values()), pa.int64())], ["lang", "gram", "n"])


def fit(labelled: DataFrame, *, doc_id: str = "doc_id", lang: str = "lang", text: str = "text", size: int = SIZE, per_language: int = PER_LANGUAGE) -> dict[str, np.ndarray]:
    """Profiles by language, each ``size`` packed n-grams at most."""
    labelled = labelled.where(F.col(lang).isNotNull()).select(F.col(doc_id).alias("i"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    n = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not n:
        return {}
    share = F.create_map(*[F.lit(x) for lang, rows in n.items() for x in (lang, min(1.0, per_language / rows))])
    place = F.conv(F.substring(F.md5(F.concat(F.lit("lang:"), F.coalesce(F.col("i").cast("string"), F.lit(""))).cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)
    sums = labelled.where(place < share[F.col("lang")]).select("lang", "text").mapInArrow(tx.tidy(_counting), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = sums.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("r") <= size)
    out: dict[str, list] = {}
    for r in best.orderBy("lang", "r").collect():  # ``size`` rows a language
        out.setdefault(r["lang"], []).append(r["gram"])
    return {k: np.array(v, np.uint64) for k, v in out.items()}


class Profiles:
    """Ranks of every profiled n-gram in every language."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.names, self.size = sorted(profiles), size
        self.codes = np.unique(np.concatenate(list(profiles.values()))) if profiles else np.zeros(0, np.uint64)
        self.ranks = np.full((len(self.codes) + 1, len(self.names)), -1, np.int64)  # the last row: in no profile
        for j, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.codes, profiles[name]), j] = np.arange(len(profiles[name]))

    def judge(self, text: str | None) -> tuple[str, float]:
        own = top(*grams(text), self.size)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        ranks = self.ranks[np.where(self.codes[at] == own, at, len(self.codes))]
        distance = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(0)
        best = int(distance.argmin())
        return self.names[best], float(1 - distance[best] / (len(own) * self.size))


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], *, text: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` and lang_pred, score (0 to 1, nearness to the chosen profile)."""
    shared = docs.sparkSession.sparkContext.broadcast(Profiles(profiles, size))
    fields = [f for f in docs.schema if f.name not in ("lang_pred", "score")]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    text_at, names = [f.name for f in fields].index(text), [f.name for f in fields]

    def judge(batches) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        target, p = to_arrow_schema(schema), shared.value
        for batch in batches:
            said = [p.judge(x.as_py()) for x in batch.column(text_at)]
            out = pa.RecordBatch.from_arrays([*[batch.column(i).cast(target.field(i).type) for i in range(len(names))], pa.array([x[0] for x in said], pa.string()), pa.array([x[1] for x in said], pa.float64())], schema=target)
            yield from tx.pieces(out, tx.flat(batch.column(text_at))[1])

    return docs.select(*names).mapInArrow(tx.tidy(judge), schema)
