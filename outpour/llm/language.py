"""Language identification by hierarchical discrimination: the family first, then the languages within it.

Features: counts of byte 1-, 2- and 3-grams of the lower-cased text, hashed to ``DIMS`` places, square-rooted and scaled
to length one. Linear support vector machines, one for each pair of families and, within each family, one for each pair
of its languages, are fitted by dual coordinate descent; votes decide, then summed margins, then the name.

The machines are fitted on a bounded sample: at most ``max_rows`` labelled rows in all, drawn evenly over the languages by
a hash of the text, copies counted once (``fit``). Everything else covers whole texts and all rows, and prediction is a map without a shuffle.

Null texts and texts without a letter are ``und`` with score 0. Rows with a null language are not learned from. With
one learned language every other text gets it with score 1; with none, everything is ``und``. Ties of votes and margins go to the
smaller name. An empty table gives no rows; columns of ``carry`` named lang_pred or score are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from outpour.llm.store import ship

UNDETERMINED = "und"
DIMS = 1 << 12
MAX_ROWS = 4000
MAX_LANGUAGES = 200
#: Texts of a language that are drawn at least, by expectation, so that none is left without any by chance.
LEAST = 20

# Families of languages by ISO 639-1 code. A code not listed is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "indo-aryan": ["bn", "hi", "mr", "pa", "ur"],
}
_FAMILY_OF = {language: family for family, languages in FAMILIES.items() for language in languages}
_LETTER = regex.compile(r"\p{L}")


def features(text: str) -> np.ndarray:
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    counts = np.bincount(data, minlength=DIMS).astype(np.float32)
    code = data
    for size in (2, 3):
        if len(data) < size:
            break
        code = (code[:-1] << np.uint32(8)) | data[size - 1 :]
        places = (code * np.uint32(2654435761)) >> np.uint32(32 - DIMS.bit_length() + 1)
        counts += np.bincount(places, minlength=DIMS)
    np.sqrt(counts, out=counts)
    length = np.sqrt(counts @ counts)
    return counts / length if length else counts


@dataclass(frozen=True)
class Contest:
    """A machine between two names: a positive margin is for the first."""

    first: str
    second: str
    weights: np.ndarray
    bias: float


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    between: tuple[Contest, ...]
    within: dict[str, tuple[Contest, ...]]

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        point = features(text)
        family, score = _winner(self.between, list(self.within), point)
        members = [language for language in self.languages if _family(language) == family]
        language, inner = _winner(self.within[family], members, point)
        return language, score * inner


def _family(language: str) -> str:
    return _FAMILY_OF.get(language, language)


def _winner(contests: tuple[Contest, ...], names: list[str], point: np.ndarray) -> tuple[str, float]:
    """The name with most wins, and how sure its weakest contest is (0 to 1)."""
    wins, margins, weakest = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, np.inf)
    for contest in contests:
        margin = float(contest.weights @ point) + contest.bias
        for name, own in ((contest.first, margin), (contest.second, -margin)):
            wins[name] += own > 0
            margins[name] += own
            weakest[name] = min(weakest[name], own)
    best = max(sorted(names), key=lambda name: (wins[name], margins[name]))
    return best, float(1 / (1 + np.exp(-4 * np.clip(weakest[best], -9, 9)))) if contests else 1.0


def fit(
    labelled: DataFrame, text_column: str, lang_column: str, max_rows: int = MAX_ROWS, max_languages: int = MAX_LANGUAGES
) -> Model:
    """A model of the labelled rows; rows with a null label are left out.

    ``max_rows`` bounds the sample that is fitted on: about ``max_rows / languages`` different texts of each language, those
    with the smallest hash, and all of a language that has fewer; texts are drawn before features are computed from them,
    and copies of a text count and are learned from once. ``max_languages`` bounds the languages that are learned: those with the
    most different texts (ties: the smaller name), so that stray labels do not fill the driver.
    """
    ship(labelled.sparkSession)
    rows = labelled.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    rows = rows.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    # Texts are drawn by their hash, so what a share gives goes by different texts, not by rows.
    different = rows.groupBy("lang").agg(F.count_distinct(F.xxhash64("text")).alias("texts"))
    different = different.where(F.col("lang") != UNDETERMINED).orderBy(F.desc("texts"), "lang").limit(max_languages)
    sizes = {row["lang"]: row["texts"] for row in different.collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return Model((), (), {})
    each = max(1, max_rows // len(languages))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(1 << 30)
    share = F.lit(None)
    wanted = max(1.2 * each, LEAST)
    for language in languages:
        share = F.when(F.col("lang") == language, F.lit(min(1.0, wanted / sizes[language]))).otherwise(share)
    # Copies of a text are one row of the sample, so a group of copies neither fills it nor crowds others out.
    drawn = rows.where(draw <= share).groupBy("lang", F.xxhash64("text").alias("hash")).agg(F.min("text").alias("text"))
    drawn = drawn.select("lang", "text").limit(max(2 * max_rows, 2 * LEAST * len(languages)))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            points = [features(text).astype(np.float16).tobytes() for text in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(points, pa.binary())], ["lang", "point"])

    found = drawn.mapInArrow(batches, "lang string, point binary").collect()
    points: dict[str, list[bytes]] = {}
    for row in sorted(found, key=lambda row: (row["lang"], bytes(row["point"]))):
        points.setdefault(row["lang"], []).append(bytes(row["point"]))
    del found
    matrices = {}
    for language in list(points):
        own = points.pop(language)
        matrices[language] = np.frombuffer(b"".join(own), np.float16).reshape(-1, DIMS).astype(np.float32)
    languages = tuple(sorted(matrices))
    families = {}
    for language in languages:
        families.setdefault(_family(language), []).append(language)
    together = {family: [matrices[language] for language in own] for family, own in families.items()}
    within = {family: _contests({name: [matrices[name]] for name in own}) for family, own in families.items()}
    return Model(languages, _contests(together), within)


def _contests(points: dict[str, list[np.ndarray]]) -> tuple[Contest, ...]:
    return tuple(Contest(a, b, *_machine(points[a], points[b])) for a, b in combinations(sorted(points), 2))


def _machine(first: list[np.ndarray], second: list[np.ndarray], cost: float = 10.0, passes: int = 12) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine (squared hinge loss), by dual coordinate descent.

    Both classes weigh the same, however many rows they have.
    """
    rows = [sum(map(len, side)) for side in (first, second)]
    # One array for all points and the place of the bias: it is what takes memory on the driver.
    points = np.full((sum(rows), DIMS + 1), 0.3, np.float32)
    start = 0
    for matrix in (*first, *second):
        points[start : start + len(matrix), :DIMS] = matrix
        start += len(matrix)
    sign = np.concatenate([np.ones(rows[0]), -np.ones(rows[1])])
    balance = np.concatenate([np.full(n, len(points) / (2.0 * n)) for n in rows])
    slack = 1 / (2 * cost * balance)
    size = np.concatenate([(part * part).sum(axis=1) for part in np.array_split(points, len(points) // 256 + 1)]) + slack
    alpha, weights, order = np.zeros(len(points)), np.zeros(points.shape[1], np.float32), np.random.default_rng(7)
    for _ in range(passes):
        for i in order.permutation(len(points)).tolist():
            gradient = sign[i] * float(weights @ points[i]) - 1 + slack[i] * alpha[i]
            new = max(alpha[i] - gradient / size[i], 0.0)
            if new != alpha[i]:
                weights += np.float32((new - alpha[i]) * sign[i]) * points[i]
                alpha[i] = new
    return weights[:-1].copy(), float(weights[-1] * 0.3)


def identify(docs: DataFrame, model: Model, text_column: str, carry: list[str]) -> DataFrame:
    """The columns of ``carry`` with lang_pred and score."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    names = [name for name in carry if name not in ("lang_pred", "score")]
    own_text = [] if text_column in names else [F.col(text_column).alias("__text")]
    rows = docs.select(*[F.col(f"`{name}`") for name in names], *own_text)
    place = len(names) if own_text else names.index(text_column)
    out = StructType([*rows.drop("__text").schema, *StructType.fromDDL("lang_pred string, score double")])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in parts:
            found = [own.predict(text) for text in part.column(place).to_pylist()]
            columns = [part.column(k) for k in range(len(names))]
            columns += [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    return rows.mapInArrow(batches, out)
