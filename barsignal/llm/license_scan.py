"""License scan by ordered signature rules, in DataFrame functions only.

A text is its words: ASCII letters lower-cased, everything but ASCII digits,
letters and non-ASCII characters is a separator. Words that begin a rule (its
anchors) are found by a set lookup; at each such place the rules of that
anchor whose gate keyword is among the next words are tried on these words.
Detections are word intervals. Of two of which one contains the other, that
with the larger priority stays, then the longer, then the earlier rule's; an
interval is given up if any such rival beats it. Intervals are shorter than
``REACH`` words, so a place has rivals among its neighbours only and a text of
any length costs time in proportion. Everything happens inside the row: no
shuffle, no join, no state.

Base phrases are found everywhere and their labels are never suppressed.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsignal.llm.license_rules import BASE, REACH, RULES

# ASCII characters that separate words once letters are lower-case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_SCORE = 0.6
RESULTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")
_RULE = "struct<o:int,label:string,p:int,gate:string,pattern:string>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once for the row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    # The one character whose lower case is a single ASCII letter (the Kelvin
    # sign) is swapped for another non-ASCII one: only A-Z become a-z.
    lower = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Å")))
    return F.array_remove(F.split(lower, SEPARATORS), "")


def _rules_by_anchor() -> Column:
    found = defaultdict(list)
    for rule in RULES:
        for anchor in rule.anchors:
            found[anchor].append({"o": rule.order, "label": rule.label, "p": rule.priority, "gate": f" {rule.gate} ", "pattern": rule.pattern})
    return F.from_json(F.lit(json.dumps(found)), f"map<string,array<{_RULE}>>")


def _places(words: Column) -> Column:
    """(at, tail) of every anchor: its place and the words from there on, a space before and after each."""
    anchors = sorted({a for rule in RULES for a in rule.anchors} | {phrase.split(" ")[0] for phrase in BASE})
    at = F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(*anchors), i)))
    return F.transform(at, lambda i: F.struct(
        i.cast("long").alias("at"), F.concat(F.array_join(F.slice(words, i + 1, F.lit(REACH)), " "), F.lit(" ")).alias("tail"),
    ))


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def _detections(place: Column, rules: Column) -> Column:
    """What the rules of a place's anchor find there: (s, e, p, o, label), e beyond the last word."""
    anchor = F.substring_index(place["tail"], " ", 1)
    mine = F.coalesce(F.element_at(rules, anchor), F.array().cast(f"array<{_RULE}>"))
    spaced = F.concat(F.lit(" "), place["tail"])
    tried = F.filter(mine, lambda r: spaced.contains(r["gate"]))
    met = F.transform(tried, lambda r: F.struct(
        place["at"].alias("s"), (place["at"] + _spaces(F.call_function("regexp_extract", place["tail"], r["pattern"], F.lit(0)))).alias("e"),
        r["p"].alias("p"), r["o"].alias("o"), r["label"].alias("label"),
    ))
    return F.filter(met, lambda d: d["e"] > d["s"])


def _beats(e: Column, d: Column) -> Column:
    """Whether e and d contain one another and e ranks above d."""
    within = ((e["s"] <= d["s"]) & (e["e"] >= d["e"])) | ((d["s"] <= e["s"]) & (d["e"] >= e["e"]))
    longer, same = (e["e"] - e["s"]) > (d["e"] - d["s"]), (e["e"] - e["s"]) == (d["e"] - d["s"])
    above = (e["p"] > d["p"]) | ((e["p"] == d["p"]) & (longer | (same & (e["o"] < d["o"]))))
    return within & above


def _kept(met: Column) -> Column:
    """The detections that no rival beats; ``met`` are the detections by place, ascending."""
    def at_place(own: Column, i: Column) -> Column:
        # Places differ, so those within REACH words are among the next REACH on either side.
        first = F.greatest(i - (REACH - 2), F.lit(1))
        rivals = F.flatten(F.slice(met, first, i + 1 - first + REACH))
        return _let(rivals, lambda near: F.filter(own, lambda d: ~F.exists(near, lambda e: _beats(e, d))))

    return F.flatten(F.transform(met, at_place))


def _starting(places: Column, phrase: str) -> Column:
    return F.transform(F.filter(places, lambda p: p["tail"].startswith(f"{phrase} ")), lambda p: p["at"])


def license_scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels, score and detections.

    ``detections`` is the array of kept (start, length, label, priority) in
    text order. ``labels`` are the base labels and those of the kept
    detections, distinct, sorted and comma-joined; ``score`` is the largest
    priority over 100, at least 0.6 where a base phrase stands, and 0 without
    any. A null or empty text has no words, no label, null first and last
    words and score 0. Repeated rows are scanned alike; columns of those names
    are replaced.
    """
    rules = _rules_by_anchor()

    def scanned(words: Column) -> Column:
        return _let(_places(words), lambda places: _digest(words, places))

    def _digest(words: Column, places: Column) -> Column:
        starts = F.flatten(F.array(*[_starting(places, phrase) for phrase in BASE]))
        base = F.array_compact(F.array(*[F.when(F.size(_starting(places, phrase)) > 0, F.lit(label)) for phrase, label in BASE.items()]))
        met = F.filter(F.transform(places, lambda p: _detections(p, rules)), lambda own: F.size(own) > 0)
        kept = _let(met, _kept)
        return F.struct(F.size(words).cast("long").alias("n_words"), starts.alias("starts"), base.alias("base"), kept.alias("kept"))

    own = [F.col(f"`{c}`") for c in docs.columns if c not in RESULTS]
    found = _let(words_of(F.col(f"`{text}`")), scanned)
    # One struct per row, bound once: its fields are read below.
    results = _let(found, lambda f: F.struct(
        f["n_words"].alias("n_words"),
        F.size(f["starts"]).cast("long").alias("n_base"),
        F.array_min(f["starts"]).alias("first_word"),
        F.array_max(f["starts"]).alias("last_word"),
        F.array_join(F.array_sort(f["base"]), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(f["base"], F.transform(f["kept"], lambda d: d["label"])))), ",").alias("labels"),
        F.greatest(
            F.coalesce(F.array_max(F.transform(f["kept"], lambda d: d["p"])) / F.lit(100.0), F.lit(0.0)),
            F.when(F.size(f["base"]) > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0)),
        ).alias("score"),
        F.transform(f["kept"], lambda d: F.struct(
            d["s"].alias("start"), (d["e"] - d["s"]).alias("length"), d["label"].alias("label"), d["p"].alias("priority"),
        )).alias("detections"),
    ))
    name = "_found"
    while name in docs.columns:
        name += "_"
    return docs.select(*own, results.alias(name)).select(*own, f"{name}.*")
