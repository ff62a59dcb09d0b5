"""Language identification in two steps: the family first, then the language within it.

Texts are counts of byte n-grams, hashed. One-versus-one linear support vector machines tell families
apart, others the languages of one family. Each machine is trained in a task of its own, on a
bounded sample per language.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.llm.common import packed, text_batches
from revtide.session import stored

#: Training rows per language at most, those of the smallest hashes.
SAMPLE_PER_LANGUAGE = 1_000
DIMENSIONS = 1 << 15
ORDERS = (2, 3, 4)
EPOCHS = 12
COST = 4.0
FOLDS = 5
UNDETERMINED = "und"

# Language codes by family. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fo fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tt tk",
    "indic": "hi bn mr ne pa gu or as ur sa",
    "dravidian": "ta te kn ml",
    "iranian": "fa ku ps tg",
    "semitic": "ar he am mt",
    "sinitic": "zh yue wuu",
    "austronesian": "id ms tl jv su",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

# ASCII other than letters says nothing about the language.
_BLANK = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in range(256))


def family(language: str) -> str:
    return FAMILY_OF.get(language.split("-")[0].lower(), language)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(places, weights) of a text: damped counts of all its n-grams, of length one."""
    raw = text.lower().encode("utf-8", "surrogatepass").translate(_BLANK)
    line = np.frombuffer(b" " + b" ".join(raw.split()) + b" ", np.uint8).astype(np.uint32)
    grams = []
    for n in ORDERS:
        code = np.zeros(max(0, len(line) - n + 1), np.uint32)
        for k in range(n):
            code = code << np.uint32(8) | line[k:k + len(code)]
        grams.append((code + np.uint32(n)) * np.uint32(2654435761) >> np.uint32(17))
    counts = np.bincount(np.concatenate(grams), minlength=DIMENSIONS)
    places = np.flatnonzero(counts)
    weights = np.log1p(counts[places]).astype(np.float32)
    return places.astype(np.int32), weights / np.float32(np.sqrt((weights * weights).sum()) or 1)


def machine(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray) -> np.ndarray:
    """Weights and bias of a linear support vector machine, by dual coordinate descent.

    Rows are visited in a fixed random order, so equal samples give equal machines.
    """
    w = np.zeros(DIMENSIONS + 1, np.float64)
    alpha = np.zeros(len(rows))
    share = {s: len(rows) / (2 * max(1, int((signs == s).sum()))) for s in (-1.0, 1.0)}
    random = np.random.default_rng(1)
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            (places, weights), sign = rows[i], signs[i]
            gradient = sign * (w[places] @ weights + w[-1]) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), COST * share[sign])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign
                alpha[i] = new
                w[places] += step * weights
                w[-1] += step
    return w.astype(np.float32)


def _train(group: pd.DataFrame) -> pd.DataFrame:
    rows = list(zip(group["places"], group["weights"]))
    order = np.argsort(group["hash"].to_numpy(), kind="stable")
    signs = np.where(group["side"].to_numpy(), 1.0, -1.0)
    w = machine([rows[i] for i in order], signs[order])
    return pd.DataFrame({"pair": [group["pair"].iloc[0]], "w": [w]})


class Model:
    """Languages by family, and the machines: (a, b) is positive for a."""

    def __init__(self, languages: list[str], machines: dict[tuple[str, str, str], np.ndarray]):
        self.tree = defaultdict(list)
        for language in sorted(languages):
            self.tree[family(language)].append(language)
        self.machines = machines

    def duel(self, level: str, names: list[str], row) -> tuple[str, float]:
        """The name with most wins, then the largest sum of margins; and how sure its closest win is."""
        places, weights = row
        wins, sums, close = defaultdict(int), defaultdict(float), defaultdict(lambda: np.inf)
        for a, b in combinations(names, 2):
            w = self.machines.get((level, a, b))
            margin = 0.0 if w is None else float(w[places] @ weights + w[-1])
            wins[a if margin >= 0 else b] += 1
            for name, m in ((a, margin), (b, -margin)):
                sums[name] += m
                close[name] = min(close[name], m)
        best = max(names, key=lambda n: (wins[n], sums[n]))
        margin = close[best] if len(names) > 1 else np.inf
        return best, float(1 / (1 + np.exp(-2 * min(margin, 50.0))))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.tree or not has_letter(text):
            return UNDETERMINED, 0.0
        row = features(text)
        best, sure = self.duel("family", sorted(self.tree), row)
        language, again = self.duel(best, self.tree[best], row)
        return language, sure * again


def held_out(identity: Column) -> Column:
    """Whether a row is kept from training; a row without id is neither learnt from nor held out."""
    return F.coalesce(F.crc32(identity.cast("string")) % FOLDS == 0, F.lit(False))


def train(df: DataFrame, text: str = "text", lang: str = "lang", id_column: str = "doc_id") -> Model:
    """Learn from the rows that have a language and letters and are not held out.

    Per language about ``SAMPLE_PER_LANGUAGE`` rows are drawn by a hash of id and text, never more. What
    reaches a training task is bounded by it, whatever the size of the table.
    """
    spark = df.sparkSession
    text_batches(spark)
    named = df.select(
        df[lang].cast("string").alias("lang"), df[text].alias("text"),
        F.xxhash64(df[id_column], df[text]).alias("hash"), df[id_column].alias("id"),
    ).filter(F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    named = named.filter(F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in named.groupBy("lang").count().collect()}
    if not counts:
        return Model([], {})
    rate = F.create_map(*[
        F.lit(x) for c, n in counts.items() for x in (c, min(1.0, 1.1 * SAMPLE_PER_LANGUAGE / n))
    ])
    drawn = named.filter(F.pmod("hash", F.lit(1 << 40)) < F.element_at(rate, F.col("lang")) * F.lit(float(1 << 40)))

    def featured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [features(t) for t in frame["text"]]
            yield pd.DataFrame({
                "lang": frame["lang"], "hash": frame["hash"],
                "places": [r[0] for r in rows], "weights": [r[1] for r in rows],
            })

    rows = drawn.select("lang", "hash", "text").mapInPandas(
        featured, "lang string, hash long, places array<int>, weights array<float>"
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    sample = stored(rows.withColumn("place", place).filter(F.col("place") <= SAMPLE_PER_LANGUAGE), "sample")
    model = Model(list(counts), {})
    # (level, a, b, languages and their quota on either side)
    duels = [
        (name, a, b, {a: SAMPLE_PER_LANGUAGE}, {b: SAMPLE_PER_LANGUAGE})
        for name, own in model.tree.items() for a, b in combinations(own, 2)
    ]
    quota = {f: {c: -(-SAMPLE_PER_LANGUAGE // len(own)) for c in own} for f, own in model.tree.items()}
    duels += [("family", a, b, quota[a], quota[b]) for a, b in combinations(sorted(model.tree), 2)]
    if not duels:
        return model
    sides = spark.createDataFrame(
        [(i, code, most, side) for i, duel in enumerate(duels) for side, part in ((True, duel[3]), (False, duel[4]))
         for code, most in part.items()],
        "pair int, code string, most int, side boolean",
    )
    picked = sample.join(sides, (sample["lang"] == sides["code"]) & (sample["place"] <= sides["most"]))
    trained = picked.select("pair", "side", "hash", "places", "weights").groupBy("pair").applyInPandas(
        _train, "pair int, w array<float>"
    )
    for row in trained.collect():
        model.machines[duels[row["pair"]][:3]] = np.array(row["w"], np.float32)
    return model


def predicted(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``df``) and ``language``: struct of lang_pred and score in [0, 1].

    A null text, one without a letter, and any text for a model without languages are ``und`` with
    score 0. Whole texts are read; nothing but the text decides.
    """
    spark = df.sparkSession
    text_batches(spark)
    shared = spark.sparkContext.broadcast((dict(model.tree), model.machines))

    @F.pandas_udf("lang_pred string, score double")
    def tell(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tree, machines = shared.value
        known = Model([c for own in tree.values() for c in own], machines)
        for batch in batches:
            yield pd.DataFrame([known.predict(t) for t in batch], columns=["lang_pred", "score"])

    return packed(df, language=tell(df[text]))
