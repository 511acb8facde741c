"""Language identification: first the language family, then one-versus-one linear support vector machines inside it.

A whole text becomes counts of hashed byte 2-, 3- and 4-grams of its lower-cased letters, scaled to unit length. The machines are fitted on the
executors, one a task, from at most `per_lang` whole labelled texts of each language (the bound is the parameter; which texts is decided by a hash of the
text); a machine between families takes at most `per_lang` texts of each family. Every text is scored by all of them in Arrow batches.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, prepare, slices

UNKNOWN = "und"
DIMS = 1 << 13
PER_LANG = 1000
MIN_SCORE = 0.3  # below it the machines contradict one another
SEED = 17

# Families of ISO 639-1 codes; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "semitic": "am ar he mt",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def features(texts: list[str | None]) -> np.ndarray:
    """Unit rows of hashed n-gram counts; a text without letters gives zeros."""
    out = np.zeros((len(texts), DIMS), np.float32)
    for row, text in zip(out, texts, strict=True):
        raw = np.frombuffer((" " + _NOT_LETTERS.sub(" ", (text or "").lower()).strip() + " ").encode("utf-8", "replace"), np.uint8).astype(np.uint32)
        if len(raw) < 3:
            continue
        two = raw[:-1] << 8 | raw[1:]
        three = two[:-1] << 8 | raw[2:]
        four = three[:-1] << 8 | raw[3:]
        for grams, salt in ((two, 0x9E3779B1), (three, 0x85EBCA77), (four, 0xC2B2AE3D)):
            if len(grams):
                row += np.bincount((grams * np.uint32(salt)) >> np.uint32(32 - DIMS.bit_length() + 1), minlength=DIMS)
        np.sqrt(row, out=row)
        row /= max(float(np.linalg.norm(row)), 1e-9)
    return out


def fit_svm(x: np.ndarray, at: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 12) -> tuple[np.ndarray, float]:
    """(weights, bias) of a linear SVM with hinge loss on the rows `at` of x, for their y in {-1, 1}, by dual coordinate descent; classes weigh alike."""
    rng, n = np.random.default_rng(SEED), len(y)
    w, bias, alpha = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(n)
    share = {s: max(1, int((y == s).sum())) for s in (-1, 1)}
    top = np.array([c * n / (2 * share[int(s)]) for s in y])
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(n):
            a = min(max(alpha[i] - (y[i] * (float(x[at[i]] @ w) + bias) - 1) / 2.0, 0.0), top[i])
            if (step := (a - alpha[i]) * y[i]) != 0.0:
                w += np.float32(step) * x[at[i]]
                bias += step
                alpha[i], moved = a, max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


@dataclass
class Model:
    families: dict[str, list[str]]
    weights: np.ndarray  # DIMS x machines
    bias: np.ndarray
    family_machines: list[tuple[str, str, int]]
    lang_machines: dict[str, list[tuple[str, str, int]]]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of each text; `und` and 0 without a letter."""
        margins = features(texts) @ self.weights + self.bias
        chance = 1 / (1 + np.exp(-4 * margins.astype(np.float64)))
        langs, scores = [], np.zeros(len(texts))
        for i, text in enumerate(texts):
            if not text or not any(map(str.isalpha, text)):
                langs.append(UNKNOWN)
                continue
            family, p = _vote(sorted(self.families), self.family_machines, chance[i])
            lang, q = _vote(self.families[family], self.lang_machines[family], chance[i])
            langs.append(lang)
            scores[i] = p * q
        return langs, scores


def _vote(names: list[str], machines: list[tuple[str, str, int]], chance: np.ndarray) -> tuple[str, float]:
    """The name with most one-versus-one votes, then the larger sum of chances, then the first; and its mean chance."""
    votes, total = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
    for a, b, k in machines:
        votes[a if chance[k] >= 0.5 else b] += 1
        total[a] += chance[k]
        total[b] += 1 - chance[k]
    best = max(names, key=lambda n: (votes[n], total[n]))
    return best, total[best] / (len(names) - 1) if len(names) > 1 else 1.0


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, h, places, values) of each text: what of its features is not zero."""
    for batch in slices(batches, "text", 2 << 20):
        x = features(batch.column(2).to_pylist())
        at = [np.flatnonzero(row).astype("<u2") for row in x]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([k.tobytes() for k in at], pa.binary()), pa.array([row[k].astype("<f4").tobytes() for k, row in zip(at, x, strict=True)], pa.binary())],
            names=["lang", "h", "places", "values"],
        )


def _fit_machine(per_side: int):
    def fit(rows: pa.Table) -> pa.Table:
        """One machine: (machine, weights, bias) from the texts of its two sides, the per_side with the smallest hashes of each."""
        machine = rows.column("machine")[0].as_py()
        order = np.argsort(rows.column("h").to_numpy(), kind="stable")
        side = rows.column("side").to_numpy()[order]
        order = np.concatenate([order[side == s][:per_side] for s in (-1, 1)])
        places, values, y = (rows.column(c).take(pa.array(order)) for c in ("places", "values", "side"))
        x = np.zeros((len(order), DIMS), np.float32)
        for row, at, value in zip(x, places.to_pylist(), values.to_pylist(), strict=True):
            row[np.frombuffer(at, "<u2")] = np.frombuffer(value, "<f4")
        weights, bias = fit_svm(x, np.arange(len(order)), y.to_numpy())
        return pa.table({"machine": pa.array([machine], pa.int32()), "weights": pa.array([weights.astype("<f4").tobytes()], pa.binary()), "bias": pa.array([bias], pa.float64())})

    return fit


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", per_lang: int = PER_LANG) -> Model | None:
    """Fit on at most per_lang texts of each language, those with the smallest hashes, whole; None when there is no labelled text with a letter.

    To the driver come the names of the languages and DIMS weights for each pair of families and of languages in a family."""
    spark = docs.sparkSession
    prepare(spark)
    part = docs.select(F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text")).where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    sizes = {r["lang"]: r["n"] for r in part.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    families: dict[str, list[str]] = {}
    for n in sorted(sizes):
        families.setdefault(FAMILY_OF.get(n, n), []).append(n)
    sides: list[tuple[int, str, int, float]] = []  # machine, language, side, share of the language's sample

    def machines(groups: dict[str, list[str]]) -> list[tuple[str, str, int]]:
        out, keys = [], sorted(groups)
        for i, a in enumerate(keys):
            for b in keys[i + 1 :]:
                number = sides[-1][0] + 1 if sides else 0
                sides.extend((number, n, sign, 1 / len(groups[g])) for g, sign in ((a, 1), (b, -1)) for n in groups[g])
                out.append((a, b, number))
        return out

    top = machines(families)
    inside = {f: machines({n: [n] for n in ns}) for f, ns in families.items()}
    if not sides:
        return Model(families, np.zeros((DIMS, 1), np.float32), np.zeros(1, np.float32), top, inside)
    # Hashes are uniform: a threshold keeps a little over per_lang texts, and no language has to be sorted.
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, (per_lang + 4 * math.sqrt(per_lang)) / n))])
    place = F.pmod("h", F.lit(1 << 30)) / (1 << 30)
    chosen = part.where(place < share[F.col("lang")]).dropDuplicates(["lang", "h"])
    sample = materialise(chosen.mapInArrow(_sample_features, "lang string, h bigint, places binary, values binary"), "sample")
    table = F.broadcast(spark.createDataFrame(sides, "machine int, lang string, side int, part double"))  # a row for each language of each machine
    dealt = sample.join(table, "lang").where(place < share[F.col("lang")] * F.col("part")).withColumn("h", F.pmod("h", F.lit(1 << 30))).select("machine", "side", "h", "places", "values")
    fitted = dealt.groupBy("machine").applyInArrow(_fit_machine(per_lang), "machine int, weights binary, bias double").collect()
    discard(sample)
    weights, bias = np.zeros((DIMS, sides[-1][0] + 1), np.float32), np.zeros(sides[-1][0] + 1, np.float32)
    for r in fitted:
        weights[:, r["machine"]], bias[r["machine"]] = np.frombuffer(r["weights"], "<f4"), r["bias"]
    return Model(families, weights, bias, top, inside)


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for batch in slices(batches, "_text", 2 << 20):
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(part.num_columns - 1).to_pylist()
                langs, scores = fitted.predict(texts) if fitted else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
                names = [*part.schema.names[:-1], "_lang_pred", "_score"]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=names)

    return run


def held_out(id_col: str = "doc_id"):
    """True for rows kept from learning; a null id is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, model: Model | None, keep: list[str], *, text_col: str = "text") -> DataFrame:
    """The columns `keep` of docs with _lang_pred and _score. Without a model every row is `und`."""
    prepare(docs.sparkSession)
    share = docs.sparkSession.sparkContext.broadcast(model)  # DIMS floats for each pair of families and of languages in a family
    frame = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1])
    return frame.mapInArrow(_scorer(share), f"{schema}, _lang_pred string, _score double")


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = PER_LANG) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row. Learning uses text and non-null lang of rows that are not held out; predictions see the
    text alone. Null texts and texts without a letter are `und` with score 0. Repeated rows and null ids keep their rows."""
    model = train(docs.where(~held_out(id_col)), text_col=text_col, lang_col=lang_col, per_lang=per_lang)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return predict(rows, model, ["doc_id", "held_out"]).select("doc_id", "held_out", F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"))


def keep_identified(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", langs: list[str] | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of docs, all columns as they are, whose text has a language: one of `langs`, where given, and of min_score or more. Rows without a
    label get the predicted one.

    With nothing to learn from it is not known which: all texts with a letter stay, or none of `langs`."""
    model = train(docs.where(~held_out(id_col)), text_col=text_col, lang_col=lang_col)
    if model is None and not langs:
        return docs.where(F.col(text_col).rlike("\\p{L}"))
    found = predict(docs, model, docs.columns, text_col=text_col)
    wanted = (F.col("_lang_pred") != UNKNOWN) & (F.col("_score") >= min_score) & (F.col("_lang_pred").isin(langs) if langs else F.lit(True))
    return found.where(wanted).select(*[F.coalesce(F.col(c), F.col("_lang_pred")).alias(c) if c == lang_col else F.col(c) for c in docs.columns])
