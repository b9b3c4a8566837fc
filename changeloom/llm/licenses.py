r"""Licence scans by ordered signature rules. Native: DataFrame functions only.

1. A-Z become lower case and words are `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`; the text is
   held as these words with one space between them.
2. Prefilter: of the distinct keywords of all rules, those that the text contains (and
   "licen" too, where a keyword's matches all hold it). Only rules that own one of them are matched.
3. Each such rule's regex gives its matches in the whole text, with places, in one pass.
4. Overlaps: a detection inside another one's interval is suppressed if the other's
   rule has priority; with equal priority the longer interval wins, then the earlier
   rule. Detections that merely overlap both stay. Base phrases (priority 0) always stay.
   What can suppress a detection lies near it, so only detections of one stretch of WINDOW
   characters are compared, however long the text.

Cases: null text counts as empty; a text without words has no labels, score 0 and null
places; repeated rows give repeated results; texts of any length are scanned whole; an empty table
gives an empty result; columns other than the two named ones are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .license_rules import BASE_PHRASES, MAX_MATCH_CHARS, RULES, Rule

WINDOW = 4096
#: Marks around matches: normalised text holds no control characters.
_OPEN, _CLOSE = "\x01", "\x02"
#: What a keyword that is part of many words may need beside it.
NEEDED = "licen"
#: The two other characters whose lower case holds an ASCII letter; they are words' characters and stay such.
_KELVIN, _DOTTED_I = "\u212a", "\u0130"


def normalise(text: Column) -> Column:
    """Words in lower case, two spaces between them: each word has spaces of its own."""
    text = F.replace(F.replace(common.text_or_empty(text), F.lit(_KELVIN), F.lit("\u0138")), F.lit(_DOTTED_I), F.lit("\u0131"))
    words = F.regexp_replace(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "  ")
    return F.trim(words)


def _spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def _rule_table(rules: tuple[Rule, ...], number: dict[str, int]) -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("rank"), F.lit(r.id).alias("id"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"),
                F.array(*(F.lit(number[k]) for k in r.keyword.split("|"))).alias("keywords"), F.lit(r.regex).alias("regex"), F.lit(r.confidence).alias("confidence"),
            )
            for i, r in enumerate(rules)
        )
    )


def _matches(text: Column, rule: Column) -> Column:
    """Detections of a rule in a whole text, or null without any: the text is marked where the
    regex matches, and the lengths between marks give the places."""

    def places(parts: Column) -> Column:
        # the first part lies before the first match; any other is a match, its end mark and what follows
        sizes = F.transform(parts, lambda p, i: (F.length(p) - F.when(i > 0, 1).otherwise(0)).cast("long"))

        def one(start: Column, part: Column) -> Column:
            return F.struct(
                start.alias("start"), (start + F.length(F.substring_index(part, _CLOSE, 1))).alias("end"), rule["rank"].alias("rank"), rule["id"].alias("rule"),
                rule["label"].alias("label"), rule["priority"].alias("priority"), rule["confidence"].alias("confidence"),
            )

        return _once(common.running_sums(sizes), lambda starts: F.zip_with(F.slice(starts, F.lit(2), F.size(parts)), F.slice(parts, F.lit(2), F.size(parts)), one))

    marked = F.regexp_replace(text, rule["regex"], F.lit(f"{_OPEN}$0{_CLOSE}"))
    return _once(marked, lambda m: F.when(m.contains(_OPEN), _once(F.split(m, _OPEN, -1), places)))


def _kept(detections: Column) -> Column:
    """Those that no other one suppresses. What suppresses a detection starts at most a match's
    length before it, so detections are compared within stretches of WINDOW characters and that
    length before; the result does not depend on the stretches."""

    def beats(e: Column, d: Column) -> Column:
        longer, as_long = (e["end"] - e["start"]) > (d["end"] - d["start"]), (e["end"] - e["start"]) == (d["end"] - d["start"])
        order = (e["priority"] < d["priority"]) | ((e["priority"] == d["priority"]) & (longer | (as_long & (e["rank"] < d["rank"]))))
        return (e["start"] <= d["start"]) & (d["end"] <= e["end"]) & order

    def within(w: Column) -> Column:
        near = F.filter(detections, lambda d: (d["start"] >= w * WINDOW - MAX_MATCH_CHARS) & (d["start"] < (w + 1) * WINDOW))
        return _once(near, lambda n: F.filter(n, lambda d: (d["start"] >= w * WINDOW) & ((d["priority"] == 0) | ~F.exists(n, lambda e: beats(e, d)))))

    windows = F.array_sort(F.array_distinct(F.transform(detections, lambda d: F.floor(d["start"] / WINDOW).cast("long"))))
    return F.flatten(F.transform(windows, within))


def _held(text: Column, number: dict[str, int], needs: str) -> Column:
    """Numbers of the keywords with the suffix `needs` that the text contains."""
    own = {k.removesuffix(f"&{NEEDED}"): n for k, n in number.items() if k.endswith(f"&{NEEDED}") == bool(needs)}
    if not own:
        return F.array().cast("array<int>")
    table = F.array(*(F.struct(F.lit(n).alias("n"), F.lit(k).alias("k")) for k, n in own.items()))
    return F.transform(F.filter(table, lambda x: text.contains(x["k"])), lambda x: x["n"])


def detections(words: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Detections that stay, with places in characters of the single-spaced text `words`."""
    number = {k: n for n, k in enumerate(sorted({k for r in rules for k in r.keyword.split("|")}))}
    table = _rule_table(rules, number)

    def found(text: Column) -> Column:
        # each word has a space before it
        present = _once(F.concat(F.lit(" "), text), lambda t: F.concat(_held(t, number, ""), F.when(t.contains(NEEDED), _held(t, number, f"&{NEEDED}")).otherwise(F.array().cast("array<int>"))))
        gate = lambda there: F.filter(
            F.when(F.size(there) > 0, table).otherwise(F.slice(table, 1, 0)),
            lambda r: F.exists(r["keywords"], lambda k: F.array_contains(there, k)),
        )
        every = F.flatten(F.filter(F.transform(_once(present, gate), lambda r: _matches(text, r)), lambda ds: ds.isNotNull()))
        return _once(every, lambda ds: F.when(F.size(ds) > 0, _kept(ds)).otherwise(ds))

    return _once(words, found)


def _once(value: Column, then) -> Column:
    """`then(value)` with value computed once: a one-element array is Spark's let."""
    return F.transform(F.array(value), then)[0]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row: id, n_words, base places and labels, detections (spans), labels, score."""
    out = docs.select(F.col(id_col), normalise(F.col(text_col)).alias("words"))
    out = out.withColumn("n_words", F.when(F.col("words") == "", 0).otherwise((_spaces(F.col("words")) / 2 + 1)).cast("long"))
    padded = F.concat(F.lit(" "), F.col("words"), F.lit(" "))
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE_PHRASES:
        own = " " + phrase.replace(" ", "  ") + " "
        n_own = phrase.count(" ") + 1
        there = F.col("words").contains(own.strip()) & padded.contains(own)
        pieces = F.split(padded, own, -1)
        half = lambda piece: (_spaces(piece) / 2).cast("long")
        counts.append(F.when(there, F.size(pieces) - 1).otherwise(0).cast("long"))
        firsts.append(F.when(there, half(pieces[0])))
        lasts.append(F.when(there, F.col("n_words") - half(F.element_at(pieces, -1)) - n_own))
        labels.append(F.when(there, F.lit(label)))
    single = F.replace(F.col("words"), F.lit("  "), F.lit(" "))
    out = out.withColumns(
        {
            "n_base": sum(counts[1:], counts[0]),
            "first_word": F.least(*firsts),
            "last_word": F.greatest(*lasts),
            "base_labels": F.sort_array(F.array_compact(F.array(*labels))),
            "detections": detections(single, rules),
        }
    )
    found = F.transform("detections", lambda d: d["label"])
    return out.select(
        id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "detections",
        F.sort_array(F.array_union("base_labels", found)).alias("labels"),
        F.greatest(F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0)).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: all rules over every whole text of documents."""
    out = scan(common.read_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )
