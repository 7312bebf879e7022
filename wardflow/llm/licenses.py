"""License scans: ordered signature rules over the words of whole texts.

A rule is a regular expression over words joined by single spaces, with a label, a confidence and a
place in the order. Rules are gated twice by keywords, without loss: only stretches of REACH words
around an anchor word are looked at, since each match holds one and is shorter than that, and in a
stretch only rules whose gate word is there are run.

Detections overlap, as a general rule often matches inside a particular one. They are settled from
left to right: one inside another goes, of two that overlap in part the rule that comes first in
the order stays. The three base phrases are rules too, and are reported whether they stay or not.

All of it is column arithmetic within a row: nothing is shuffled.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words. Fixed values.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Base phrases and their labels. Fixed values.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: label; names, the first as in identifiers; versions. Licenses that are often named first come first.
FAMILIES = """
agpl; agpl, gnu affero general public, gnu agpl, affero general public, affero gpl; 1 0, 3 0
lgpl; lgpl, gnu lesser general public, gnu library general public, gnu lgpl, lesser gpl; 2 0, 2 1, 3 0
gfdl; gfdl, gnu free documentation, gnu fdl; 1 1, 1 2, 1 3
gpl; gpl, gnu general public, gnu gpl, gnu public, general public; 1 0, 2 0, 3 0
apache; apache, apache software; 1 0, 1 1, 2 0
mpl; mpl, mozilla public, mozilla; 1 0, 1 1, 2 0
epl; epl, eclipse public; 1 0, 2 0
edl; edl, eclipse distribution; 1 0
eupl; eupl, european union public; 1 0, 1 1, 1 2
cddl; cddl, common development and distribution; 1 0, 1 1
cpl; cpl, common public; 1 0
cpal; cpal, common public attribution; 1 0
ipl; ipl, ibm public; 1 0
npl; npl, netscape public; 1 0, 1 1
spl; spl, sun public; 1 0
osl; osl, open software; 1 0, 1 1, 2 0, 2 1, 3 0
afl; afl, academic free; 1 1, 1 2, 2 0, 2 1, 3 0
artistic; artistic, perl artistic, clarified artistic; 1 0, 2 0
cecill; cecill, cecill free software; 1 0, 1 1, 2 0, 2 1
cecill-b; cecill b;
cecill-c; cecill c;
ofl; ofl, sil ofl, sil open font, open font; 1 0, 1 1
bsl; bsl, boost software, boost; 1 0
busl; busl, business source; 1 1
sspl; sspl, server side public; 1 0
elastic; elastic; 1 0, 2 0
ms-pl; ms pl, microsoft public;
ms-rl; ms rl, microsoft reciprocal;
lppl; lppl, latex project public; 1 0, 1 1, 1 2, 1 3
php; php; 3 0, 3 01
python; python, python software foundation, psf; 2 0
zpl; zpl, zope public; 1 1, 2 0, 2 1
w3c; w3c, w3c software notice and;
ncsa; ncsa, university of illinois ncsa open source;
openssl; openssl, openssl ssleay;
postgresql; postgresql;
ruby; ruby;
vim; vim;
zlib; zlib, zlib libpng;
libpng; libpng; 2 0
isc; isc, internet systems consortium;
icu; icu, unicode icu;
unicode; unicode, unicode dfs;
curl; curl;
fsfap; fsfap, fsf all permissive;
json; json;
beerware; beerware, beer ware;
wtfpl; wtfpl, do what the fuck you want to public; 2 0
unlicense; unlicense;
0bsd; 0bsd, zero clause bsd, bsd zero clause;
bsd-1-clause; bsd 1 clause, one clause bsd;
bsd-2-clause; bsd 2 clause, two clause bsd, simplified bsd, freebsd;
bsd-3-clause; bsd 3 clause, three clause bsd, new bsd, modified bsd, revised bsd;
bsd-4-clause; bsd 4 clause, four clause bsd, original bsd;
bsd; bsd, bsd style;
mit-0; mit 0, mit no attribution;
mit; mit, expat, x11, mit x11, mit style;
cc0; cc0, cc zero, creative commons zero, creative commons cc0; 1 0
cc-by-nc-nd; cc by nc nd, creative commons attribution noncommercial noderivatives, creative commons attribution non commercial no derivatives; 2 0, 2 5, 3 0, 4 0
cc-by-nc-sa; cc by nc sa, creative commons attribution noncommercial sharealike, creative commons attribution non commercial share alike; 2 0, 2 5, 3 0, 4 0
cc-by-nc; cc by nc, creative commons attribution noncommercial, creative commons attribution non commercial; 2 0, 2 5, 3 0, 4 0
cc-by-nd; cc by nd, creative commons attribution noderivatives, creative commons attribution no derivatives; 2 0, 2 5, 3 0, 4 0
cc-by-sa; cc by sa, creative commons attribution sharealike, creative commons attribution share alike; 2 0, 2 5, 3 0, 4 0
cc-by; cc by, creative commons attribution; 2 0, 2 5, 3 0, 4 0
creative-commons; creative commons;
odbl; odbl, open database; 1 0
odc-by; odc by, open data commons attribution; 1 0
pddl; pddl, public domain dedication and; 1 0
ogl; ogl, open government; 1 0, 2 0, 3 0
"""

LICENSE_WORDS = ("license", "licence", "licensed", "licenced", "licenses", "licences")
#: Words that, standing by themselves, are rare enough to be looked for without a license word.
RARE = ("agpl lgpl gfdl gpl gnu affero apache mpl mozilla epl eupl cddl osl cecill ofl bsl busl sspl lppl fsfap wtfpl "
        "unlicense 0bsd bsd cc0 cc creative odbl pddl spdx copyleft proprietary gplv2 gplv3 lgplv2 lgplv3 agplv3").split()
ANCHORS = (*LICENSE_WORDS, *RARE, "domain", "rights", "permission", "redistribution", "warranty")
REACH = 24  # words; a match has fewer

#: Wordings without a name: label; gate; expression; confidence in percent.
WORDINGS = [
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy", 90),
    ("agpl-3", "agplv3", "agplv3(?: 0)?", 90),
    ("lgpl-2", "lgplv2", "lgplv2(?: 0)?(?! \\d)", 90),
    ("lgpl-2.1", "lgplv2", "lgplv2 1", 90),
    ("lgpl-3", "lgplv3", "lgplv3(?: 0)?", 90),
    ("gpl-2", "gplv2", "gplv2(?: 0)?", 90),
    ("gpl-3", "gplv3", "gplv3(?: 0)?", 90),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose", 90),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification", 80),
    ("public-domain", "domain", "(?:released|placed|dedicated|is|put) (?:in|into|to) the public domain", 80),
    ("public-domain", "domain", "public domain", 40),
    ("proprietary", "proprietary", "proprietary (?:and confidential|licen[sc]e|software)", 70),
    ("all-rights-reserved", "rights", "all rights reserved", 60),
    ("no-warranty", "warranty", "without (?:any )?warranty of any kind", 30),
    ("copyleft", "copyleft", "copyleft(?: licen[sc]e)?", 30),
    ("unknown-license", "under", "licen[sc]ed under (?:the )?(?:terms of )?", 10),
    ("unknown-license", "identifier", "spdx license identifier", 10),
    ("unknown-license", "license", "(?:see|this|the) license(?: file| agreement)?", 10),
]


class Rule(NamedTuple):
    """`gate` is a word, with a space on each side, that every match has."""

    order: int
    label: str
    gate: str
    pattern: str
    confidence: int
    base: bool


def _version(words: str) -> str:
    """A version with or without its trailing 0, `v` or `version` before it."""
    major, minor = words.split()
    tail = "(?: 0)?" if minor == "0" else f" {minor}"
    return rf"(?:(?:version |ver |v )?{major}|v{major}){tail}(?! \d)"


def _version_label(words: str) -> str:
    return words.removesuffix(" 0").replace(" ", ".")


def rules() -> list[Rule]:
    """All rules by priority: base phrases, then the more telling form before the less telling one
    and, within a form, families as listed."""
    under = r"(?:released|distributed|available|published|provided|covered|offered|made available) under (?:the )?(?:terms of (?:the )?)?"
    licensed = r"licen[sc]ed under (?:the )?(?:terms of (?:the )?)?"
    word = r"(?: licen[sc]e)"
    forms: dict[int, list[tuple[str, str, str, int]]] = {k: [] for k in range(9)}
    for line in FAMILIES.split("\n"):
        if not line:
            continue
        label, names, versions = (x.strip() for x in line.split(";"))
        for i, name in enumerate(names.split(", ")):
            own = name.split()
            rare = any(w in RARE for w in own)
            gate = next((w for w in own if w in RARE), max(own, key=len))
            for v in versions.split(", ") if versions else []:
                this, as_text = f"{label}-{_version_label(v)}", _version(v)
                # The license word may stand on either side of the version; a rare name needs none.
                named = rf"{name}{word}? {as_text}{word}?" if rare else rf"{name}(?:{word} {as_text}| {as_text}{word})"
                if label in ("gpl", "lgpl", "agpl", "gfdl"):
                    forms[0].append((f"{this}-or-later", gate, rf"{named} or (?:at your option )?(?:any )?later(?: version)?", 100))
                if i == 0:
                    forms[1].append((this, gate, rf"spdx licen[sc]e identifier {name} {as_text}(?: only)?", 100))
                forms[2].append((this, gate, rf"{licensed}{name}{word}? {as_text}{word}?", 100))
                forms[3].append((this, gate, named, 95))
            if i == 0:
                forms[4].append((label, gate, rf"spdx licen[sc]e identifier {name}", 90))
            forms[5].append((label, gate, rf"(?:{licensed}{name}{word}?|{under}{name}{word})", 85))
            forms[6].append((label, gate, rf"{name}{word}", 80))
            forms[7].append((label, gate, rf"licen[sc]e {name}", 60))
            if rare:
                forms[8].append((label, gate, name, 50))
    found = [(label, max(p.split(), key=len), p, 100, True) for p, label in BASE.items()]
    found += [(*r, False) for k in sorted(forms) for r in forms[k]]
    found += [(*r, False) for r in WORDINGS]
    return [Rule(i, label, f" {gate} ", f"(?<= )(?:{p.strip()})(?= )", c, base) for i, (label, gate, p, c, base) in enumerate(found)]


def _table(chosen: list[Rule]) -> Column:
    """The rules as a constant array of structs, read from one text: a literal for each value would
    take Spark long to analyse."""
    return F.from_json(F.lit(json.dumps([r._asdict() for r in chosen])),
                       "array<struct<order:int,label:string,gate:string,pattern:string,confidence:int,base:boolean>>")


def _stretches(words: Column, at: Column) -> Column:
    """Stretches (start, text) of `words` around the sorted anchor places `at`; those that touch are one."""
    gap = 2 * REACH
    first = F.transform(
        F.filter(at, lambda x, i: F.coalesce(x - F.get(at, i - 1) > gap, F.lit(True))),
        lambda x: F.greatest(x - REACH, F.lit(0)))
    last = F.transform(
        F.filter(at, lambda x, i: F.coalesce(F.get(at, i + 1) - x > gap, F.lit(True))), lambda x: x + REACH)
    return F.zip_with(first, last, lambda a, b: F.struct(
        a.alias("start"), F.concat(F.lit(" "), F.array_join(F.slice(words, a + 1, b - a + 1), " "), F.lit(" ")).alias("text")))


def _spans(stretch: Column, rule: Column) -> Column:
    """All matches of a rule in a stretch, as words: matches are marked at both ends and the marks counted off."""
    marked = F.split(F.trim(F.regexp_replace(stretch["text"], rule["pattern"], F.lit("\x01$0\x02"))), " ")
    places = F.transform(marked, lambda w, i: F.struct(
        F.when(F.startswith(w, F.lit("\x01")), i).alias("a"), F.when(F.endswith(w, F.lit("\x02")), i + 1).alias("b")))
    starts = F.filter(F.transform(places, lambda p: p["a"]), lambda x: x.isNotNull())
    ends = F.filter(F.transform(places, lambda p: p["b"]), lambda x: x.isNotNull())
    return F.zip_with(starts, ends, lambda a, b: F.struct(
        (stretch["start"] + a).alias("start"), (-(stretch["start"] + b)).alias("minus_end"), rule["order"].alias("order"),
        rule["label"].alias("label"), rule["confidence"].alias("confidence"), rule["base"].alias("base")))


def _settled(hits: Column) -> Column:
    """Labels and highest confidence of the detections that stay, of `hits` by start, then longest, then order."""
    none = F.lit(None)
    begin = F.struct(
        none.cast("int").alias("minus_end"), none.cast("int").alias("order"), none.cast("string").alias("label"),
        F.lit(0).alias("confidence"), F.array().cast("array<string>").alias("labels"), F.lit(0).alias("best"))

    def step(state: Column, hit: Column) -> Column:
        # `state` has the last detection that stays so far; a minus sign turns comparisons of ends round.
        apart = F.coalesce(hit["start"] >= -state["minus_end"], F.lit(True))
        wins = ~apart & (hit["minus_end"] < state["minus_end"]) & (hit["order"] < state["order"])
        new = apart | wins
        closed = apart & state["label"].isNotNull()
        return F.struct(
            F.when(new, hit["minus_end"]).otherwise(state["minus_end"]).alias("minus_end"),
            F.when(new, hit["order"]).otherwise(state["order"]).alias("order"),
            F.when(new, hit["label"]).otherwise(state["label"]).alias("label"),
            F.when(new, hit["confidence"]).otherwise(state["confidence"]).alias("confidence"),
            F.when(closed, F.array_union(state["labels"], F.array(state["label"]))).otherwise(state["labels"]).alias("labels"),
            F.when(closed, F.greatest(state["best"], state["confidence"])).otherwise(state["best"]).alias("best"))

    return F.aggregate(hits, begin, step, lambda s: F.struct(
        F.array_compact(F.array_union(s["labels"], F.array(s["label"]))).alias("labels"),
        F.greatest(s["best"], s["confidence"]).alias("best")))


def find_licenses(docs: DataFrame, chosen: list[Rule] | None = None) -> DataFrame:
    """Per row of `docs(doc_id, text)`: `n_words`, the base phrases (`n_base` places, smallest and
    largest start, labels), `labels` with those of all rules that stay, the highest confidence of
    these as `score` from 0 to 1, and `detections`, all (start, end, label, confidence) before they
    are settled, in words from 0, ends exclusive.

    A null or empty text has no words, a null doc_id stays null, equal rows give equal rows, and an
    empty table gives none. Texts of any length are read whole; a row's arrays grow with its own
    text. Other columns are not read.
    """
    stems = sorted({w[:5] if w.startswith("licen") else w for w in ANCHORS})
    table = _table(rules() if chosen is None else chosen)
    text = F.trim(F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), SEPARATORS, " "))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("_t")).select(
        "doc_id",
        F.when(F.col("_t") == "", 0).otherwise(
            F.octet_length("_t") - F.octet_length(F.replace("_t", F.lit(" "))) + 1).cast("long").alias("n_words"),
        # In either case, as only ASCII letters are alike to this flag.
        F.when(F.concat(F.lit(" "), F.col("_t")).rlike(f"(?i) (?:{'|'.join(stems)})"),
               F.split(F.translate("_t", UPPER, LOWER), " ")).alias("_words"))
    placed = plain.withColumn("_at", F.filter(
        F.transform("_words", lambda w, i: F.when(w.isin(*ANCHORS), i)), lambda x: x.isNotNull()))
    stretches = placed.withColumn("_stretches", _stretches(F.col("_words"), F.col("_at"))).drop("_words", "_at")
    hits = stretches.withColumn("_hits", F.sort_array(F.flatten(F.transform(
        "_stretches", lambda s: F.flatten(F.transform(
            F.filter(table, lambda r: F.contains(s["text"], r["gate"]) & F.rlike(s["text"], r["pattern"])),
            lambda r: _spans(s, r))))))).drop("_stretches")
    settled = hits.withColumn("_kept", _settled(F.col("_hits"))).withColumn("_base", F.filter("_hits", lambda h: h["base"]))
    base_labels = F.array_distinct(F.transform("_base", lambda h: h["label"]))
    no_labels = F.array().cast("array<string>")
    return settled.select(
        "doc_id", "n_words", F.coalesce(F.size("_base"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.transform("_base", lambda h: h["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("_base", lambda h: h["start"])).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.coalesce(base_labels, no_labels)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(
            F.coalesce(base_labels, no_labels), F.coalesce(F.col("_kept")["labels"], no_labels))), ",").alias("labels"),
        (F.when(F.size("_base") > 0, 100).otherwise(F.coalesce(F.col("_kept")["best"], F.lit(0))) / F.lit(100.0)).alias("score"),
        F.transform(F.coalesce("_hits", F.array().cast(hits.schema["_hits"].dataType)), lambda h: F.struct(
            h["start"].alias("start"), (-h["minus_end"]).alias("end"), h["label"].alias("label"),
            h["confidence"].alias("confidence"))).alias("detections"))
