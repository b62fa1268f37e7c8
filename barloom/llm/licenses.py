"""Operator 9: license detection by ordered signature rules; DataFrame functions only.

A rule is a regular expression over a text's words (A-Z lowered, joined by single spaces), with a
keyword, a label and a priority. Rules come from families of licenses and from forms of speech, so
a new family or form adds one line. A text's words are searched only by the rules whose keyword
occurs among them, together with a word of the rule's form; both are plain strings, which every match of
the rule holds. A detection that lies inside another one of at least its priority is dropped; of
equal ones the higher priority stays.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.llm.texts import free_names, table

#: Words that stand consecutively, and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label, keyword, the name as words, and the versions that are told apart.
FAMILIES = [
    ("mit", "mit", "mit", ()),
    ("x11", "x11", "x11", ()),
    ("isc", "isc", "isc", ()),
    ("zlib", "zlib", "zlib(?: libpng)?", ()),
    ("boost", "boost", "boost(?: software)?", ("1 0",)),
    ("apache", "apache", "apache(?: software)?", ("1 0", "1 1", "2 0")),
    ("bsd", "bsd", "(?:[0-4] clause |new |modified |simplified )?bsd(?: [0-4] clause)?", ()),
    ("gpl", "general public", "(?:gnu )?general public", ("1 0", "2 0", "3 0", "1", "2", "3")),
    ("gpl", "gpl", "(?:gnu )?gpl", ("1 0", "2 0", "3 0", "1", "2", "3")),
    ("lgpl", "lesser general", "(?:gnu )?lesser general public", ("2 1", "3 0", "3")),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", ("2 1", "3 0", "3")),
    ("agpl", "affero", "(?:gnu )?affero general public", ("3 0", "3")),
    ("agpl", "agpl", "(?:gnu )?agpl", ("3 0", "3")),
    ("gfdl", "free documentation", "(?:gnu )?free documentation", ("1 1", "1 2", "1 3")),
    ("mpl", "mozilla", "mozilla public", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse", "eclipse public", ("1 0", "2 0")),
    ("cddl", "common development", "common development and distribution", ("1 0", "1 1")),
    ("cpl", "common public", "common public", ("1 0",)),
    ("eupl", "european union", "european union public", ("1 1", "1 2")),
    ("artistic", "artistic", "artistic", ("1 0", "2 0")),
    ("ofl", "open font", "(?:sil )?open font", ("1 0", "1 1")),
    ("odbl", "open database", "open database", ("1 0",)),
    ("ms-pl", "microsoft public", "microsoft public", ()),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal", ()),
    ("postgresql", "postgresql", "postgresql", ()),
    ("python", "python software", "python software foundation", ("2",)),
    ("php", "php", "php", ("3 0", "3 01")),
    ("wtfpl", "wtfpl", "wtfpl", ("2",)),
    ("unlicense", "unlicense", "unlicense", ()),
    ("cc0", "cc0", "cc0", ("1 0",)),
    ("cc-by", "cc by", "cc by", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "cc by sa", "cc by sa", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "cc by nc", "cc by nc", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "cc by nd", "cc by nd", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "commons attribution", "creative commons attribution", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "share", "creative commons attribution share ?alike", ("2 0", "3 0", "4 0")),
    ("cc-by-nc", "commercial", "creative commons attribution non ?commercial", ("2 0", "3 0", "4 0")),
]

_KIND = "(?: public)?(?: licen[cs]e)?"
_VERSION = "(?: version| v| ver)? v?{version}(?: or (?:any )?later)?(?: international| unported)?"
#: Form, priority, confidence, and whether it is asked of a family with or without version.
FORMS = [
    ("spdx license identifier {name}" + _KIND + _VERSION, 6, 0.99, True),
    ("spdx license identifier {name}", 6, 0.98, False),
    ("(?:licensed|released|published|distributed|available) under (?:the )?(?:terms of (?:the )?)?{name}" + _KIND + _VERSION, 5, 0.97, True),
    ("(?:licensed|released|published|distributed|available) under (?:the )?(?:terms of (?:the )?)?{name}" + _KIND, 4, 0.95, False),
    ("{name}" + _KIND + _VERSION, 3, 0.85, True),
    ("{name} licen[cs]e", 2, 0.8, False),
]
#: Notices without a family: label, keyword, words, priority and confidence.
NOTICES = [
    ("copyright", "copyright", "copyright(?: c)?(?: (?:19|20)[0-9]{2})+", 1, 0.4),
    ("public-domain", "public domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", 4, 0.9),
    ("proprietary", "confidential", "proprietary and confidential", 4, 0.9),
    ("proprietary", "redistribution", "redistribution (?:is|are) (?:strictly )?(?:prohibited|forbidden)", 4, 0.8),
    ("bsd", "redistribution", "redistribution and use in source and binary forms", 5, 0.9),
    ("mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", 5, 0.95),
    ("isc", "with or without fee", "permission to use copy modify and or distribute this software for any purpose with or without fee", 5, 0.95),
]

_OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TOP = 6
BASE_CONFIDENCE = {"cc-by": 0.7, "gpl": 0.8, "reserved": 0.6}


def rules() -> list[tuple[str, str, str, int, float]]:
    """All rules as (label, keyword, expression, priority, confidence), in order."""
    made = [(label, phrase, phrase, 1, BASE_CONFIDENCE[label]) for phrase, label in BASE_PHRASES.items()]
    for label, keyword, name, versions in FAMILIES:
        for form, priority, sure, versioned in FORMS:
            if not versioned:
                made.append((label, keyword, form.replace("{name}", name), priority, sure))
                continue
            for version in versions:
                words = form.replace("{name}", name).replace("{version}", version)
                made.append((f"{label}-{version.replace(' ', '.')}", keyword, words, priority, sure))
    made += [(label, keyword, words, priority, sure) for label, keyword, words, priority, sure in NOTICES]
    return [(label, keyword, f"(?<= ){words}(?= )", priority, sure) for label, keyword, words, priority, sure in made]


def gate() -> dict[str, list[tuple[str, tuple[str, str, int, float]]]]:
    """The rules as (form's word, (label, expression, priority, confidence)) by the string that their matches hold.

    A keyword stands as whole words, unless a blank may be left out before or after it.
    """
    out: dict[str, list] = {}
    for label, keyword, expression, priority, sure in rules():
        held = keyword if " ?" in expression else f" {keyword} "
        if "identifier " in expression:
            form = " identifier "
        elif " under " in expression:
            form = " under "
        elif expression.endswith(" licen[cs]e(?= )"):
            form = " licen"
        else:
            form = " "
        out.setdefault(held, []).append((form, (label, expression, priority, sure)))
    return out


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def _places(words: Column, rule: Column) -> Column:
    """A rule's detections in a text of spaced words: first and last word, and the rule's values."""
    pieces = F.split(words, rule["expression"], -1)
    hits = F.regexp_extract_all(words, rule["expression"], F.lit(0))
    pairs = F.zip_with(F.slice(pieces, 1, F.size(hits)), hits, lambda piece, hit: F.struct(_spaces(piece).alias("before"), _spaces(hit).alias("inside")))
    kind = "array<struct<first:int,last_desc:int,priority_desc:int,label:string,sure:double>>"
    start = F.struct(F.lit(-1).alias("at"), F.array().cast(kind).alias("found"))

    def step(state: Column, pair: Column) -> Column:
        first = state["at"] + pair["before"]
        last = first + pair["inside"]
        one = F.struct(
            first.alias("first"), (-last).alias("last_desc"), (-rule["priority"]).alias("priority_desc"),
            rule["label"].alias("label"), rule["sure"].alias("sure"),
        )
        return F.struct(last.alias("at"), F.concat(state["found"], F.array(one)).alias("found"))

    return F.aggregate(pairs, start, step, lambda state: state["found"])


def _kept(found: Column) -> Column:
    """Detections left when those inside one of at least their priority are dropped."""
    kind = "array<struct<first:int,last:int,priority:int,label:string,sure:double>>"
    start = F.struct(
        F.array(*[F.lit(-1)] * TOP).alias("reach"), F.array().cast(kind).alias("kept")
    )

    def step(state: Column, one: Column) -> Column:
        last, priority = -one["last_desc"], -one["priority_desc"]
        inside = F.array_max(F.slice(state["reach"], priority, F.lit(TOP) - priority + 1)) >= last
        reach = F.transform(state["reach"], lambda r, i: F.when(i + 1 == priority, F.greatest(r, last)).otherwise(r))
        row = F.struct(one["first"].alias("first"), last.alias("last"), priority.alias("priority"), one["label"].alias("label"), one["sure"].alias("sure"))
        return F.struct(reach.alias("reach"), F.when(inside, state["kept"]).otherwise(F.concat(state["kept"], F.array(row))).alias("kept"))

    # sorted by first word, then the longer, then the higher priority
    return F.aggregate(F.array_sort(found), start, step, lambda state: state["kept"])


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs``, ``n_words``, ``base`` and ``detections``; columns of those names are replaced.

    ``base`` has every place of a base phrase (``label``, ``first``); ``detections`` those of all
    rules that are left: first and last word from 0, ``priority``, ``label``, ``sure``. A null,
    empty or wordless text has 0 words and empty arrays. Repeated rows give the same.
    """
    docs = docs.drop(*({"n_words", "base", "detections"} - {text}))
    held = gate()
    base_phrases = {f" {phrase} ": label for phrase, label in BASE_PHRASES.items()}

    def rule(form: str, made: tuple[str, str, int, float]) -> Column:
        names = ("label", "expression", "priority", "sure")
        return F.struct(F.lit(form).alias("form"), *[F.lit(v).alias(n) for n, v in zip(names, made, strict=True)])

    signatures = F.array(*[
        F.struct(F.lit(word).alias("held"), F.array(*[rule(*r) for r in some]).alias("rules")) for word, some in held.items()
    ])
    # a base phrase's places are those of the rule made from it
    bases = F.array(*[rule(word, (label, f"(?<={word[0]}){word[1:-1]}(?= )", 1, 0.0)) for word, label in base_phrases.items()])
    value = F.coalesce(F.col(text), F.lit(""))
    lowered = F.translate(value, string.ascii_uppercase, string.ascii_lowercase)
    words = F.concat(F.lit(" "), F.regexp_replace(lowered, _OTHER, " "), F.lit(" "))
    words = F.regexp_replace(words, "^ +| +$", " ")

    def search(spaced: Column, which: Column) -> Column:
        live = F.filter(which, lambda r: F.contains(spaced, r["form"]))
        return F.flatten(F.transform(live, lambda r: _places(spaced, r)))

    def all_of(spaced: Column) -> Column:
        near = F.filter(signatures, lambda s: F.contains(spaced, s["held"]))
        base = F.transform(search(spaced, bases), lambda x: F.struct(x["label"].alias("label"), x["first"].alias("first")))
        detections = _kept(search(spaced, F.flatten(F.transform(near, lambda s: s["rules"]))))
        return F.struct((_spaces(spaced) - 1).cast("long").alias("n_words"), base.alias("base"), detections.alias("detections"))

    # the array of one text binds its words once for all rules
    (found,) = free_names(docs.columns, "_found")
    docs = docs.withColumn(found, F.transform(F.array(words), all_of)[0])
    return docs.withColumns({name: F.col(found)[name] for name in ("n_words", "base", "detections")}).drop(found)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    label = lambda x: x["label"]
    base, first = F.transform("base", label), F.transform("base", lambda x: x["first"])
    labels = F.array_union(base, F.transform("detections", label))
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    doubt = F.aggregate("detections", F.lit(1.0), lambda p, x: p * (1 - x["sure"]))
    return scanned.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(first).cast("long").alias("first_word"), F.array_max(first).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(labels).alias("labels"), (1 - doubt).alias("score"),
    )
