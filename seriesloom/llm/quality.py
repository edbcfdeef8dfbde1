"""Quality rules whose cutoffs are chosen under a risk guarantee.

A rule rejects a document when one of its measures lies above a cutoff. For each stratum and rule the
labelled documents are a holdout: going down a fixed list of cutoffs, from the mildest, a cutoff is
certified while the exact binomial test rejects "more than ``alpha`` of the good documents are lost".
The walk stops at the first cutoff that fails, so the list costs no correction; strata and rules are
corrected for by dividing ``delta`` among all of them (Bonferroni). With a chance of ``1 - delta`` no
certified rule loses more than ``alpha`` of the good documents of a stratum, and all rules together
lose at most ``len(RULES) * alpha``. Among certified cutoffs the one with the best balance of bad
against good documents is used; a rule that brings nothing, or has too few labels, is not used.

Defined results: null and empty texts have no words and fail the base rule; a null stratum is a
stratum of its own; labels other than 0 and 1, and labels of unknown documents, count for nothing;
without labels only the base rule acts. Rows repeated in the input are judged one by one, but the binomial
bound needs trials that do not repeat: equal texts of a stratum are one trial however often they or their labels
occur, and none where their labels disagree. Texts of any length are measured whole. Other
columns of the input are carried along, also when their names equal those of measures; only columns named like
the three that are added make way for them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as X
from .shared import mapped, numbered, ship, stored

#: Measures as whole numbers per document.
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_shouts", "n_digits",
)

#: A rule's measure as a ratio of two counts, and its cutoffs from the mildest to the strictest.
RULES = {
    "symbols": ("n_symbols", "n_words", (2.0, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1)),
    "shouts": ("n_shouts", "n_words", (2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    "upper": ("n_upper", "n_letters", (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "dup_lines": ("n_dup_lines", "n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "repeats": ("n_repeat_words", "n_words", (0.19, 0.17, 0.15, 0.12, 0.1, 0.08)),
    "digits": ("n_digits", "word_chars", (0.8, 0.6, 0.5, 0.4, 0.3, 0.2)),
}

#: A good document that is lost weighs as much as so many bad ones that stay.
GOOD_WEIGHT = 50

_MEASURES = "_measures"
_ADDED = (_MEASURES, "_base_failed", "_kept")
#: Beside the counts, a hash of the text, by which equal texts count as one trial.
_SAME = "same_text"


def _per_text(first: np.ndarray, flags: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[first[1:]] - total[first[:-1]]


def _again(keys: np.ndarray) -> np.ndarray:
    """Whether an equal key came before."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    same[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return same


def _twice(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    equal = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][equal]] = True
    out[order[:-1][equal]] = True
    return out


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of each text of a column."""
    text = X.column_bytes(column)
    data, first = text
    w = X.words(text)
    salt = X.mixed(np.arange(len(first) - 1, dtype=np.uint64), 7)
    starts = X.gram_starts(w.first, 5)
    runs = X.grams(w.hashes, 5)[starts] ^ salt[np.searchsorted(w.first, starts, "right") - 1]
    hit = starts[_twice(runs)]
    change = np.zeros(len(w.hashes) + 6, np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + 5, -1)
    covered = np.cumsum(change)[: len(w.hashes)] > 0
    # lines: each text starts one, and so does the byte after a line end
    ends = np.flatnonzero(data == 10)
    line_owner = np.concatenate((np.arange(len(first) - 1), np.searchsorted(first, ends, "right") - 1))
    line_begin = np.concatenate((first[:-1], ends + 1))
    order = np.lexsort((line_begin, line_owner))
    line_owner, line_begin = line_owner[order], line_begin[order]
    line_end = np.empty_like(line_begin)
    line_end[:-1] = line_begin[1:] - 1
    last = np.ones(len(line_owner), bool)
    last[:-1] = line_owner[1:] != line_owner[:-1]
    line_end[last] = first[line_owner[last] + 1]
    filled = np.searchsorted(w.begin, line_end) > np.searchsorted(w.begin, line_begin)
    line_owner, line_begin, line_end = line_owner[filled], line_begin[filled], line_end[filled]
    lines = X.span_hashes(data, line_begin, line_end) ^ salt[line_owner]
    n = len(first) - 1
    same = X.span_hashes(data, first[:-1], first[1:])
    upper = (data >= 65) & (data <= 90)
    return {
        "n_words": np.diff(w.first),
        "word_chars": _per_text(first, ~X.blank(data) & ((data & 0xC0) != 0x80)),
        "n_symbols": _per_text(first, np.isin(data, np.frombuffer(b"#*$%&|<>", np.uint8))),
        "n_dup_lines": np.bincount(line_owner[_again(lines)], minlength=n),
        "n_repeat_words": _per_text(w.first, covered),
        "n_lines": np.bincount(line_owner, minlength=n),
        "n_upper": _per_text(first, upper),
        "n_letters": _per_text(first, upper | ((data >= 97) & (data <= 122))),
        "n_shouts": _per_text(first, data == 33),
        "n_digits": _per_text(first, (data >= 48) & (data <= 57)),
        _SAME: same.view(np.int64),
    }


def with_measures(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all where None) and a struct of COUNTS, for every row."""
    carry = [c for c in (docs.columns if carry is None else carry) if c != _MEASURES]
    read = [F.col(f"`{c}`") for c in carry] + [F.col(f"`{text}`").alias("_text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "_text"):
            found = measure(batch.column(batch.num_columns - 1))
            names = [*COUNTS, _SAME]
            struct = pa.StructArray.from_arrays([pa.array(found[c], pa.int64()) for c in names], names)
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, struct], [*carry, _MEASURES])

    counts = T.StructType([T.StructField(c, T.LongType()) for c in (*COUNTS, _SAME)])
    fields = [T.StructField(c, docs.schema[c].dataType) for c in carry]
    return mapped(docs.select(read), run, T.StructType([*fields, T.StructField(_MEASURES, counts)]))


def base_failed(words: Column, repeats: Column) -> Column:
    return (words < 10) | (100 * repeats > 20 * words)


def _ratio(rule: str) -> Column:
    over, under, _ = RULES[rule]
    top, bottom = F.col(f"{_MEASURES}.{over}"), F.col(f"{_MEASURES}.{under}")
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def _stratum(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("\0null"))


def binomial_at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), summed exactly."""
    if k >= n:
        return 1.0
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
        + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    return min(1.0, math.fsum(map(math.exp, logs)))


def certified_cutoff(
    cutoffs: list[float], good_lost: list[int], bad_caught: list[int], good: int, alpha: float, level: float
) -> float | None:
    """The best certified cutoff of one rule in one stratum; cutoffs from mild to strict."""
    best, gain = None, 0
    for cutoff, lost, caught in zip(cutoffs, good_lost, bad_caught, strict=True):
        if good == 0 or lost > alpha * good or binomial_at_most(lost, good, alpha) > level:
            break
        if caught - GOOD_WEIGHT * lost > gain:
            best, gain = cutoff, caught - GOOD_WEIGHT * lost
    return best


def cutoffs(
    measured: DataFrame, labels: DataFrame, stratum: str, key: str, label: str, alpha: float, delta: float
) -> DataFrame:
    """A row per stratum with the cutoff of each rule, null where the rule is not used."""
    judged = measured.select(_stratum(stratum).alias("_stratum"), F.col(f"`{key}`").alias("_id"), _MEASURES)
    marks = labels.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{label}`").alias("_label"))
    joined = judged.join(marks, F.col("_id") == F.col("_key")).where(F.col("_label").isin(0, 1))
    joined = joined.where(~base_failed(F.col(f"{_MEASURES}.n_words"), F.col(f"{_MEASURES}.n_repeat_words")))
    # one trial for each text of a stratum
    joined = joined.groupBy("_stratum", _MEASURES).agg(F.min("_label").alias("_label"), F.max("_label").alias("_most"))
    joined = joined.where(F.col("_label") == F.col("_most"))
    good = F.col("_label") == 1
    counts = [F.count(F.when(good, 1)).alias("good")]
    for rule, (_, _, grid) in RULES.items():
        for i, cutoff in enumerate(grid):
            over = _ratio(rule) > cutoff
            counts += [
                F.count(F.when(good & over, 1)).alias(f"good_{rule}_{i}"),
                F.count(F.when(~good & over, 1)).alias(f"bad_{rule}_{i}"),
            ]
    table = joined.groupBy("_stratum").agg(*counts)
    table = stored(table)
    strata = table.count()
    fields = [T.StructField("_stratum", T.StringType())]
    fields += [T.StructField(f"cut_{rule}", T.DoubleType()) for rule in RULES]

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.to_dict("records"):
                level = delta / (strata * len(RULES))
                out = {"_stratum": row["_stratum"]}
                for rule, (_, _, grid) in RULES.items():
                    lost = [int(row[f"good_{rule}_{i}"]) for i in range(len(grid))]
                    caught = [int(row[f"bad_{rule}_{i}"]) for i in range(len(grid))]
                    out[f"cut_{rule}"] = certified_cutoff(grid, lost, caught, int(row["good"]), alpha, level)
                rows.append(out)
            yield pd.DataFrame(rows, columns=[f.name for f in fields])

    ship(measured.sparkSession)
    return table.mapInPandas(choose, T.StructType(fields))


def judged(
    docs: DataFrame,
    labels: DataFrame,
    *,
    text: str = "text",
    stratum: str = "lang",
    key: str = "doc_id",
    label: str = "quality",
    alpha: float = 0.01,
    delta: float = 0.05,
    carry: list[str] | None = None,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Each row with the columns ``carry``, ``_measures``, ``_base_failed`` and ``_kept``."""
    wanted = [c for c in (docs.columns if carry is None else carry) if c not in _ADDED]
    held = [key] if key == stratum else [key, stratum]
    if measured is None:
        chosen_from = with_measures(docs, text, held)
        measured = with_measures(docs, text, list(dict.fromkeys([*wanted, stratum])))
    else:
        chosen_from = measured
    table = cutoffs(chosen_from, labels, stratum, key, label, alpha, delta)
    failed = base_failed(F.col(f"{_MEASURES}.n_words"), F.col(f"{_MEASURES}.n_repeat_words"))
    rejects = [F.coalesce(_ratio(rule) > F.col(f"cut_{rule}"), F.lit(False)) for rule in RULES]
    any_rule = rejects[0]
    for one in rejects[1:]:
        any_rule = any_rule | one
    # names of our own, whatever the columns are called
    plain = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(wanted)]
    joined = measured.select(*plain, _MEASURES, _stratum(stratum).alias("_joined_on")).join(
        table, F.col("_joined_on") == F.col("_stratum"), "left"
    )
    return joined.select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(wanted)], _MEASURES,
        failed.alias("_base_failed"), (~failed & ~any_rule).alias("_kept"),
    )


def accepted(
    docs: DataFrame, labels: DataFrame, *, text: str = "text", stratum: str = "lang", key: str = "doc_id",
    label: str = "quality", **limits: float,
) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns, whatever these are called."""
    rows, names, back = numbered(docs)
    marks = labels.select(F.col(f"`{key}`").alias(names[key]), F.col(f"`{label}`").alias("label"))
    out = judged(
        rows, marks, text=names[text], stratum=names[stratum], key=names[key], label="label", **limits
    )
    return out.where("_kept").select(*back)
