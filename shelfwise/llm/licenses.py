"""License scan with a positional rare-token index, in DataFrame functions only.

A template is a sequence of words.  It is indexed under its word of the highest
IDF over all files; the next rarest word must stand at its own relative place,
then the mandatory phrases are verified word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import row_struct

#: Characters that stand in no word, once A-Z are lower-cased.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The phrases that always count, and their labels.
BASE = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

#: Notices of public licences (label, words, mandatory phrase among them).
NOTICES = (
    ("agpl-3.0", "gnu affero general public license version 3", "affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc0-1.0", "cc0 1 0 universal", "cc0 1 0"),
    ("gpl-2.0", "gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3", "general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     "permission to use copy modify and or distribute this software"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge to any person"),
    ("mit", "released under the mit license", "mit license"),
    ("mpl-2.0", "mozilla public license version 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


RESULTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places")


def words_of(text: Column) -> Column:
    """The words of a text; null has none.  Lower-casing other letters than A-Z changes no gap and no template word."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), GAPS), "")


def templates(extra: tuple = ()) -> list[dict]:
    """Every template with its words and the place and words of its mandatory phrase."""
    out = []
    for label, phrase, base in [(label, p, True) for p, label in BASE] + [(label, w, False) for label, w, _ in (*NOTICES, *extra)]:
        must = phrase if base else next(m for la, w, m in (*NOTICES, *extra) if (la, w) == (label, phrase))
        words, key = phrase.split(), must.split()
        at = next(i for i in range(len(words)) if words[i: i + len(key)] == key)
        out.append({"label": label, "base": base, "words": words, "at": at, "must": key})
    return out


def document_frequencies(texts: DataFrame, words: list[str]) -> dict[str, int]:
    """In how many rows (column ``words``) each of a fixed list of words occurs; a row per listed word reaches the driver."""
    seen = texts.select(F.explode(F.array_intersect("words", F.array(*map(F.lit, words)))).alias("w"))
    got = {r["w"]: r["n"] for r in seen.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: got.get(w, 0) for w in words}


def _index(rows: list[dict], df: dict[str, int]) -> dict[str, list[dict]]:
    """Rarest word of each mandatory phrase -> its templates, with the places of the two rarest words in the template."""
    out: dict[str, list[dict]] = {}
    for t in rows:
        ranked = sorted(range(len(t["must"])), key=lambda i: (df[t["must"][i]], t["must"][i], i))
        first, second = t["at"] + ranked[0], t["at"] + ranked[-1 if len(ranked) == 1 else 1]
        out.setdefault(t["words"][first], []).append({**t, "first": first, "second": second})
    return out


def _entry(t: dict) -> Column:
    return F.struct(F.lit(t["label"]).alias("label"), F.lit(t["base"]).alias("base"), F.lit(t["first"]).alias("first"), F.lit(t["second"]).alias("second"),
                    F.lit(t["words"][t["second"]]).alias("word"), F.lit(t["at"]).alias("at"), F.array(*map(F.lit, t["must"])).alias("must"),
                    F.array(*map(F.lit, t["words"])).alias("words"))


def scan(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, extra: tuple = ()) -> DataFrame:
    """The carried columns (all but the text, if None), then ``n_words, n_base, first_word, last_word long, base_labels,
    labels string, score double, places array<struct<label, base, start, share>>``.

    ``places`` has every verified template with its start (in words from 0, where the mandatory phrase begins) and the
    share of the template's words found at their places; ``score`` is the largest share, 0 without a place.
    ``n_base`` counts the places of the base phrases; ``first_word`` and ``last_word`` are null without one.  Null and
    empty texts have no words and the empty labels.  Repeated rows are scanned each by itself; an empty table gives
    no rows.  ``extra`` adds templates (label, words, mandatory phrase).
    """
    rows = templates(extra)
    base = docs.select(row_struct(docs, text_col, carry, RESULTS).alias("row"), words_of(docs[f"`{text_col}`"]).alias("words"))
    index = _index(rows, document_frequencies(base, sorted({w for t in rows for w in t["must"]})))
    anchors = F.array(*map(F.lit, sorted(index)))

    def verified(i: Column, e: Column, words: Column) -> Column:
        """The second rarest word stands at its relative place, and the mandatory phrase at its own."""
        start = i - e["first"]
        begin = start + e["at"]
        return ((begin >= 0) & (F.get(words, start + e["second"]) == e["word"])
                & (F.slice(words, F.greatest(begin, F.lit(0)) + 1, F.size(e["must"])) == e["must"]))

    def share(i: Column, e: Column, words: Column) -> Column:
        agree = F.transform(e["words"], lambda w, j: F.when(F.get(words, i - e["first"] + j) == w, 1.0).otherwise(0.0))
        return F.aggregate(agree, F.lit(0.0), lambda a, b: a + b) / F.size(e["words"])

    none = F.expr("cast(array() as array<struct<label: string, base: boolean, start: bigint, share: double>>)")
    # one conditional pass over the words for each anchor a file has; files without one stop at the intersection
    found = none
    for word in sorted(index, reverse=True):
        entries = F.array(*map(_entry, index[word]))
        at = F.filter(F.transform("words", lambda w, i: F.when(w == F.lit(word), i)), lambda i: i.isNotNull())
        hits = F.flatten(F.transform(at, lambda i: F.transform(
            F.filter(entries, lambda e: verified(i, e, F.col("words"))),
            lambda e: F.struct(e["label"].alias("label"), e["base"].alias("base"), (i - e["first"] + e["at"]).cast("long").alias("start"),
                               share(i, e, F.col("words")).alias("share")))))
        found = F.concat(F.when(F.array_contains("present", word), hits).otherwise(none), found)
    out = base.withColumn("present", F.array_intersect("words", anchors))
    out = out.withColumn("places", F.when(F.size("present") > 0, found).otherwise(none))
    basic = F.filter("places", lambda p: p["base"])
    starts = F.transform(basic, lambda p: p["start"])

    def joined(ps) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(ps, lambda p: p["label"]))), ",")

    return out.select("row.*", F.size("words").cast("long").alias("n_words"), F.size(basic).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                      F.array_max(starts).alias("last_word"), joined(basic).alias("base_labels"), joined(F.col("places")).alias("labels"),
                      F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"), "places")
