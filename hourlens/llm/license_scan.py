"""License scans: ordered signature rules behind a keyword prefilter, overlaps resolved by priority.

A text is brought to its words, lower-cased, with one space before each.  Only texts that
hold one of the few gate words are looked at further, and a rule's regex runs only where the
rule's own keyword, or a form that stands for it (gplv3 for gpl), occurs.  Detections become word intervals; one that lies inside the interval of a
detection of equal or better priority is suppressed.  That is a sweep per document: sorted by start
(longest first), a detection is covered if an earlier one of its class or better reaches as far.

The score is the strongest surviving detection: 1 for notice wording, 0.9 for an identifier line,
0.8 for a statement of licensing, 0.6 for a bare name, 0 without any.

Defined results: null and empty texts have no words, labels or places; repeated rows each get their
own result; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourlens.llm.common import Stages, ascii_lower

GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"

# Phrases whose every place counts, and their labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# label, keyword, name, version that may follow the name
NAMES = [
    ("mit", "mit", "mit(?: x11| expat)?", ""), ("mit", "expat", "expat", ""),
    ("x11", "x11", "x11", ""), ("mit-0", "attribution", "mit no attribution", ""),
    ("apache", "apache", "(?:asf )?apache(?: software)?", "1 0|1 1|2 0|2"),
    ("gpl", "gpl", "(?:gnu )?gpl(?:v2|v3)?", "1|2 0|2|3 0|3"),
    ("gpl", "general", "(?:gnu )?general public", "1|2 0|2|3 0|3"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl(?:v2|v3)?", "2 0|2 1|2|3 0|3"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public", "2 1|3 0|3"),
    ("lgpl", "library", "(?:gnu )?library general public", "2 0|2"),
    ("agpl", "agpl", "(?:gnu )?agpl(?:v3)?", "1 0|3 0|3"),
    ("agpl", "affero", "(?:gnu )?affero general public", "1 0|3 0|3"),
    ("gfdl", "documentation", "(?:gnu )?free documentation", "1 1|1 2|1 3"),
    ("bsd", "bsd", "(?:new |modified |simplified |original )?bsd", ""),
    ("bsd-2", "bsd", "(?:2|two) clause bsd", ""), ("bsd-2", "bsd", "bsd (?:2|two) clause", ""),
    ("bsd-3", "bsd", "(?:3|three) clause bsd", ""), ("bsd-3", "bsd", "bsd (?:3|three) clause", ""),
    ("bsd-4", "bsd", "(?:4|four) clause bsd", ""), ("bsd-4", "bsd", "bsd (?:4|four) clause", ""),
    ("isc", "isc", "isc", ""), ("zlib", "zlib", "zlib(?: libpng)?", ""),
    ("mpl", "mpl", "mpl", "1 0|1 1|2 0"), ("mpl", "mozilla", "mozilla public", "1 0|1 1|2 0"),
    ("epl", "epl", "epl", "1 0|2 0"), ("epl", "eclipse", "eclipse public", "1 0|2 0"),
    ("edl", "eclipse", "eclipse distribution", "1 0"),
    ("cddl", "cddl", "cddl", "1 0|1 1"),
    ("cddl", "distribution", "common development and distribution", "1 0|1 1"),
    ("cpl", "common", "common public", "1 0"), ("ipl", "ibm", "ibm public", "1 0"),
    ("eupl", "eupl", "eupl", "1 1|1 2"), ("eupl", "union", "european union public", "1 1|1 2"),
    ("boost", "boost", "boost(?: software)?", "1 0"), ("unlicense", "unlicense", "unlicense", ""),
    ("wtfpl", "wtfpl", "wtfpl", "1|2"), ("artistic", "artistic", "(?:perl )?artistic", "1 0|2 0"),
    ("python", "python", "python(?: software foundation)?", "2"), ("php", "php", "php", "3 0|3 01"),
    ("ruby", "ruby", "ruby", ""), ("openssl", "openssl", "openssl", ""),
    ("ofl", "ofl", "(?:sil )?ofl", "1 0|1 1"), ("ofl", "font", "(?:sil )?open font", "1 0|1 1"),
    ("ms-pl", "microsoft", "microsoft public", ""), ("ms-rl", "microsoft", "microsoft reciprocal", ""),
    ("postgresql", "postgresql", "postgresql", ""), ("ncsa", "illinois", "university of illinois", ""),
    ("afl", "academic", "academic free", "2 1|3 0"), ("osl", "open", "open software", "2 1|3 0"),
    ("upl", "permissive", "universal permissive", "1 0"), ("vim", "vim", "vim", ""),
    ("cc0", "cc0", "cc0", "1 0"), ("odbl", "odbl", "odbl", "1 0"),
    ("odbl", "database", "open (?:data commons open )?database", "1 0"),
    ("sspl", "sspl", "sspl", "1"), ("bsl", "business", "business source", "1 1"),
]
CC = [("cc-by", "by", "attribution"), ("cc-by-sa", "by sa", "attribution share ?alike"),
      ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative)?s?"),
      ("cc-by-nc", "by nc", "attribution non ?commercial"),
      ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
      ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?")]

# label, keyword, wording of a notice
NOTICES = [
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "permission", "above copyright notice and this permission notice shall be included"),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms"),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice"),
    ("bsd-3", "endorse", "endorse or promote products derived from this software without specific"),
    ("bsd-4", "advertising", "all advertising materials mentioning features or use of this software"),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public"),
    ("lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu lesser"),
    ("agpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero"),
    ("apache", "compliance", "you may not use this file except in compliance with the license"),
    ("apache", "www", "(?:https? )?www apache org licenses license 2 0"),
    ("mpl", "mozilla", "subject to the terms of the mozilla public"),
    ("zlib", "altered", "altered source versions must be plainly marked as such"),
    ("boost", "boost", "distributed under the boost software"),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain"),
    ("public-domain", "domain", "(?:dedicated to|placed in|released into|in) the public domain"),
    ("proprietary", "reserved", "all rights reserved"),
    ("proprietary", "confidential", "proprietary and confidential"),
    ("no-warranty", "warranty", "without warranty of any kind"),
    ("no-warranty", "warranties", "without warranties or conditions of any kind"),
]
# Words that open a name in place of its keyword.
FORMS = {"gpl": ["gplv2", "gplv3"], "lgpl": ["lgplv2", "lgplv3"], "agpl": ["agplv3"]}
# Every rule needs one of these, so a text without them needs no closer look.
GATE = (r"(?i)licen[cs]e|(?<![0-9a-z])under(?![0-9a-z])|spdx|cc[^0-9a-z]+by|creative[^0-9a-z]+commons|"
        + "|".join(sorted({w for _, w, _ in NOTICES})))
GRANT = "(?:licensed|released|distributed|published|available|provided|covered|governed)"
LICENSE = "licen[cs]e"


def rules() -> list[tuple[int, str, str, str, int, float]]:
    """Ordered rules: number, label, keyword, regex, priority (1 is best), score."""
    made: list[tuple[str, str, str, int, float]] = []
    for label, word, text in NOTICES:
        made.append((label, word, f" {text}", 1, 1.0))
    for label, word, name, versions in NAMES:
        end = f"(?: (?:version )?v?(?:{versions}))?(?: or later)?" if versions else ""
        made += [
            (label, word, f" spdx license identifier {name}{end}", 1, 0.9),
            (label, word, f" {GRANT} under (?:the )?(?:terms of (?:the )?)?{name}(?: {LICENSE})?{end}",
             2, 0.8),
            (label, word, f" (?:this (?:work|software|file|program) is )?licensed under (?:the )?{name}"
             f" {LICENSE}{end}", 2, 0.8),
            (label, word, f" {LICENSE} (?:is )?(?:the )?{name}(?: {LICENSE})?{end}", 3, 0.6),
            (label, word, f" {name}(?: style)? {LICENSE}{end}", 3, 0.6)]
    for label, code, words in CC:
        for keyword, name in (("cc", f"cc {code}"), ("creative", f"creative commons {words}")):
            end = "(?: international| unported)?(?: (?:1 0|2 0|2 5|3 0|4 0))?(?: international)?"
            made += [
                (label, keyword, f" spdx license identifier {name}{end}", 1, 0.9),
                (label, keyword, f" {GRANT} under (?:a |the )?{name}(?: {LICENSE})?{end}", 2, 0.8),
                (label, keyword, f" {LICENSE} {name}{end}", 3, 0.6),
                (label, keyword, f" {name}{end}(?: {LICENSE})?", 3, 0.6)]
    return [(i, lab, key, f"{rx}(?= )", pri, score)
            for i, (lab, key, rx, pri, score) in enumerate(made)]


def _spaced(text: Column) -> Column:
    """`` w0 w1 ... `` : a space before every word, one at the end."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(text), GAP, " ")), F.lit(" "))


def _places(words: Column, phrase: str) -> Column:
    """Word numbers at which the phrase's words stand one after the other."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        hit = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            hit = hit & (F.get(words, i + k) == part)
        return hit

    return F.filter(F.transform(words, lambda w, i: F.when(w == parts[0], i)),
                    lambda i: i.isNotNull() & here(i))


def detections(texts: DataFrame) -> DataFrame:
    """Surviving detections of (doc_id, hash, spaced): label, start, end (words), score."""
    table = rules()
    words = sorted({(form, r[2]) for r in table for form in (r[2], *FORMS.get(r[2], []))})
    own = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(lab).alias("label"),
                             F.lit(key).alias("keyword"), F.lit(rx).alias("regex"),
                             F.lit(p).alias("priority"), F.lit(s).alias("score"))
                    for i, lab, key, rx, p, s in table])
    forms = F.array(*[F.struct(F.lit(w).alias("form"), F.lit(key).alias("keyword")) for w, key in words])
    present = F.filter(forms, lambda w: F.contains("spaced", F.concat(F.lit(" "), w["form"], F.lit(" "))))
    present = F.array_distinct(F.transform(present, lambda w: w["keyword"]))
    gated = texts.withColumn("present", present).where(F.size("present") > 0).select(
        "doc_id", "hash", "spaced", F.explode(F.filter(
            own, lambda r: F.array_contains("present", r["keyword"]))).alias("r"))
    mark = F.lit(" \x01$0")
    hits = gated.withColumn("found", F.regexp_extract_all("spaced", F.col("r.regex"), F.lit(0))).where(
        F.size("found") > 0)
    tokens = F.split(F.regexp_replace("spaced", F.col("r.regex"), mark), " ")
    at = F.filter(F.transform(tokens, lambda t, i: F.when(t == "\x01", i)), lambda i: i.isNotNull())
    spot = F.transform(F.arrays_zip(at.alias("at"), F.col("found").alias("found")), lambda z, k: F.struct(
        (z["at"] - k - 1).alias("start"),
        (F.length(z["found"]) - F.length(F.replace(z["found"], F.lit(" ")))).alias("n")))
    flat = hits.select("doc_id", "hash", "r", F.explode(spot).alias("s")).select(
        "doc_id", "hash", "r.rule", "r.label", "r.priority", "r.score",
        F.col("s.start").alias("start"), (F.col("s.start") + F.col("s.n")).alias("end")).distinct()
    line = Window.partitionBy("doc_id", "hash").orderBy(
        "start", F.desc("end"), "priority", "rule").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.lit(False)
    for p in sorted({r[4] for r in table}):
        reach = F.max(F.when(F.col("priority") <= p, F.col("end"))).over(line)
        covered = covered | ((F.col("priority") == p) & F.coalesce(reach >= F.col("end"), F.lit(False)))
    return flat.withColumn("covered", covered).where("not covered")


def scan_licenses(docs: DataFrame, phrases=BASE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per input row."""
    stages = Stages(docs.sparkSession, "license")
    text = F.coalesce(F.col("text"), F.lit(""))
    first = "|".join(sorted({ph.split(" ")[0] for ph, _ in phrases}))
    gate = F.rlike(text, F.lit(f"{GATE}|{first}"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("hash"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
                       F.when(gate, _spaced(text)).alias("spaced"))
    words = F.split(F.trim("spaced"), " ")
    base = rows
    for k, (phrase, _) in enumerate(phrases):
        base = base.withColumn(f"at{k}", F.coalesce(_places(words, phrase), F.array().cast("array<int>")))
    every = F.flatten(F.array(*[F.col(f"at{k}") for k in range(len(phrases))]))
    named = F.array_compact(F.array(*[F.when(F.size(f"at{k}") > 0, F.lit(label))
                                      for k, (_, label) in enumerate(phrases)]))
    base = stages.write(base.select(
        "doc_id", "hash", "n_words", "spaced", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"), named.alias("named")))
    found = detections(base.where("spaced is not null").select("doc_id", "hash", "spaced"))
    labels = found.groupBy("doc_id", "hash").agg(
        F.collect_set("label").alias("more"), F.max("score").alias("best")).select(
        F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), "more", "best")
    both = base.drop("spaced").join(
        labels, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")), "left")
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    own = F.when(F.size("named") > 0, F.lit(0.6)).otherwise(F.lit(0.0))
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        joined(F.col("named")).alias("base_labels"),
        joined(F.concat("named", F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.greatest(own, F.coalesce("best", F.lit(0.0))).alias("score"))
