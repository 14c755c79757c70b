"""License detection by ordered signature rules."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import text_or_empty
from martloom.llm.license_texts import BODIES, BODY_PRIORITY, BODY_WEIGHT, NAME_PRIORITY, NAME_WEIGHT, NAMES

# The base phrases and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
BASE_WEIGHT = 0.9

# Names of licenses as they read in normalised words: label, a word every match holds, pattern of the name.
_GPL = r"(?:gnu )?{}general public licen[sc]e(?: version)?"
LICENSE_NAMES = (
    ("mit", "mit", r"(?:mit|mit x11|x11 mit)"),
    ("mit", "expat", r"expat"),
    ("apache-1.1", "apache", r"apache(?: software)?(?: licen[sc]e)?(?: version)? v?1 1"),
    ("apache-2", "apache", r"apache(?: software)?(?: licen[sc]e)?(?: version)? v?2(?: 0)?"),
    ("gpl-2", "general", _GPL.format("") + r" v?2(?: 0)?"),
    ("gpl-3", "general", _GPL.format("") + r" v?3(?: 0)?"),
    ("lgpl-2.1", "general", _GPL.format("(?:lesser|library) ") + r" v?2 1"),
    ("lgpl-3", "general", _GPL.format("lesser ") + r" v?3(?: 0)?"),
    ("agpl-3", "general", _GPL.format("affero ") + r" v?3(?: 0)?"),
    ("gpl-2", "gpl", r"(?:gnu )?gpl(?: version)? v?2(?: 0)?"),
    ("gpl-3", "gpl", r"(?:gnu )?gpl(?: version)? v?3(?: 0)?"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl(?: version)? v?2 1"),
    ("lgpl-3", "lgpl", r"(?:gnu )?lgpl(?: version)? v?3(?: 0)?"),
    ("agpl-3", "agpl", r"(?:gnu )?agpl(?: version)? v?3(?: 0)?"),
    ("gpl-2", "gplv2", r"(?:gnu )?gplv2"),
    ("gpl-3", "gplv3", r"(?:gnu )?gplv3"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation licen[sc]e(?: version 1(?: [123])?)?"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd|three clause bsd)"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd)"),
    ("0bsd", "bsd", r"(?:0bsd|zero clause bsd|bsd zero clause)"),
    ("isc", "isc", r"isc"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e(?: version)? v?1 1"),
    ("mpl-2", "mozilla", r"mozilla public licen[sc]e(?: version)? v?2(?: 0)?"),
    ("mpl-2", "mpl", r"mpl(?: version)? v?2(?: 0)?"),
    ("epl-1", "eclipse", r"eclipse public licen[sc]e(?: version)? v?1(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public licen[sc]e(?: version)? v?2(?: 0)?"),
    ("cddl-1", "common", r"common development and distribution licen[sc]e(?: version)?(?: v?1(?: 0)?)?"),
    ("cpl-1", "common", r"common public licen[sc]e(?: version)?(?: v?1(?: 0)?)?"),
    ("eupl-1.2", "european", r"european union public licen[sc]e(?: version)?(?: v?1 2)?"),
    ("artistic-2", "artistic", r"artistic(?: licen[sc]e)?(?: version)? v?2(?: 0)?"),
    ("artistic-1", "artistic", r"(?:perl )?artistic(?: licen[sc]e)?(?: version)? v?1(?: 0)?"),
    ("zlib", "zlib", r"(?:zlib|zlib libpng)"),
    ("bsl-1", "boost", r"boost software licen[sc]e(?: version)?(?: v?1(?: 0)?)?"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("postgresql", "postgresql", r"postgresql"),
    ("psf-2", "python", r"python software foundation(?: licen[sc]e)?(?: version)?(?: v?2)?"),
    ("ofl-1.1", "font", r"(?:sil )?open font licen[sc]e(?: version)?(?: v?1 1)?"),
    ("ms-pl", "microsoft", r"microsoft public"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?"),
    ("odbl-1", "database", r"open (?:data commons open )?database licen[sc]e(?: version)?(?: v?1(?: 0)?)?"),
    ("cc0-1", "cc0", r"cc0(?: 1(?: 0)?)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1234](?: [05])?)?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1234](?: [05])?)?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1234](?: [05])?)?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1234](?: [05])?)?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1234](?: [05])?)?"),
    ("cc-by", "cc", r"cc by(?: [1234](?: [05])?)?"),
    ("cc-by-nc-nd", "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative|atives|s)"),
    ("cc-by-nc-sa", "creative", r"creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc", "creative", r"creative commons attribution non ?commercial"),
    ("cc-by-nd", "creative", r"creative commons attribution no ?deriv(?:ative|atives|s)"),
    ("cc-by-sa", "creative", r"creative commons attribution share ?alike"),
    ("cc-by", "creative", r"creative commons attribution"),
)

# Ways in which a text states a license: priority, weight, pattern around the name.
STATEMENTS = (
    (6, 0.99, r"spdx licen[sc]e identifier {name}"),
    (5, 0.97, r"(?:dual )?licen[sc]ed under (?:the )?(?:terms (?:of|and conditions of) (?:the )?)?{name}(?: international)?(?: licen[sc]e)?"),
    (5, 0.97, r"(?:re)?distributed under (?:the )?(?:terms (?:of|and conditions of) (?:the )?)?{name}(?: licen[sc]e)?"),
    (5, 0.97, r"(?:released|published|available) under (?:the )?(?:terms of (?:the )?)?{name}(?: licen[sc]e)?"),
    (4, 0.9, r"under (?:the )?(?:terms of (?:the )?)?{name} licen[sc]e"),
    (3, 0.8, r"{name}(?: international)? licen[sc]e"),
    (3, 0.8, r"licen[sc]e(?:d as)? {name}"),
    (1, 0.6, r"{name}"),
)
#: A bare name counts only where it is too specific for ordinary prose.
BARE_NAME_WORDS = 2

# Words around which rules are tried, and what a text must hold for that to be worth while. Every match of a rule holds an anchor.
ANCHOR_START = "licen"
ANCHORS = ("spdx", "cc", "cc0", "gpl", "lgpl", "agpl", "gplv2", "gplv3", "unlicense", "wtfpl", "creative")
#: Anchors only before a certain next word: statements, bare names and sentences that hold none of the others.
ANCHOR_PAIRS = {
    "under": ("distributed", "redistributed", "released", "published", "available"),
    "software": ("python", "includes", "cryptographic", "unencumbered", "font"),
    "public": ("microsoft",),
    "granted": ("hereby",),
    "notice": ("permission",),
    "forms": ("binary",),
    "retain": ("must",),
    "reproduce": ("must",),
    "promote": ("or",),
    "materials": ("advertising",),
    "advertising": ("in",),
    "medium": ("any",),
    "perl": ("as",),
    "liable": ("held",),
    "evil": ("not",),
    "domain": ("public",),
    "neighboring": ("or",),
    "zero": ("publicdomain",),
    "mark": ("publicdomain",),
}
KEYWORDS = ("licen", "spdx", "gpl", "unlicense", "wtfpl", "creative", "cc0")
BETWEEN = r"[^0-9a-z\x{80}-\x{10FFFF}]+"
CC_GATE = f"cc{BETWEEN}by"
#: Words on either side of an anchor; the first anchor of every signature is that near to both of its ends.
REACH = 20

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spaced(pattern: str) -> str:
    """Every word keeps a space on both sides, so that neighbouring matches share none."""
    return " " + pattern.replace(" ?", "(?:  )?").replace(" ", "  ").replace("(?:    )?", "(?:  )?") + " "


def signature_rules() -> list[dict]:
    """All rules, highest priority first: sentences of license texts, every statement around every name, names on their own."""

    def alone(signatures: Sequence[tuple[str, str, str]], priority: int, weight: float) -> list[dict]:
        return [
            {"label": label, "need": need, "pattern": _spaced(pattern), "priority": priority, "weight": weight}
            for label, need, pattern in signatures
        ]

    rules = alone(BODIES, BODY_PRIORITY, BODY_WEIGHT)
    for priority, weight, statement in STATEMENTS:
        for label, need, name in LICENSE_NAMES:
            if statement == "{name}" and len(name.replace("(?:gnu )?", "").split("(?:")[0].split()) < BARE_NAME_WORDS:
                continue
            pattern = _spaced(statement.replace("{name}", f"(?:{name})"))
            rules.append({"label": label, "need": need, "pattern": pattern, "priority": priority, "weight": weight})
    rules += alone(NAMES, NAME_PRIORITY, NAME_WEIGHT)
    return sorted(rules, key=lambda rule: -rule["priority"])


RULE_TYPE = "array<struct<label:string,need:string,pattern:string,priority:int,weight:double>>"


def _n_words(spaced: Column) -> Column:
    return ((F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("int")


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0), lambda total, n: total + n)


def _places(words: Column, phrase: str) -> Column:
    """Word numbers at which the phrase starts, overlapping places included."""
    wanted = phrase.split()

    def here(i: Column) -> Column:
        found = F.get(words, i) == wanted[0]
        for step, word in enumerate(wanted[1:], 1):
            found = found & (F.get(words, i + step) == word)
        return found

    last = F.size(words) - len(wanted)
    none = F.array().cast("array<int>")
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), here)).otherwise(none)


def _matches(window: Column, low: Column, anchor: Column, rule: Column) -> Column:
    """Spans of one rule in a window that hold the anchor word."""
    hits = F.transform(F.regexp_extract_all(window, rule["pattern"], F.lit(0)), _n_words)
    gaps = F.transform(F.split(window, rule["pattern"], -1), _n_words)

    def span(k: Column) -> Column:
        start = low + _total(F.slice(gaps, 1, k + 1)) + _total(F.slice(hits, 1, k))
        return F.struct(
            start.alias("start"),
            (start + F.get(hits, k)).alias("end"),
            rule["label"].alias("label"),
            rule["priority"].alias("priority"),
            rule["weight"].alias("weight"),
        )

    spans = F.transform(F.sequence(F.lit(0), F.size(hits) - 1), span)
    return F.filter(spans, lambda s: (s["start"] <= anchor) & (anchor < s["end"]))


def _detections(words: Column, rules: Column) -> Column:
    """What the rules find around one anchor after another, without what a better detection contains."""

    def is_anchor(i: Column) -> Column:
        word = F.get(words, i)
        pair = F.lit(False)
        for following, firsts in ANCHOR_PAIRS.items():
            pair = pair | (word.isin(*firsts) & F.get(words, i + 1).eqNullSafe(following))
        first_of_pair = word.isin(*sorted({first for firsts in ANCHOR_PAIRS.values() for first in firsts}))
        return word.startswith(ANCHOR_START) | word.isin(*ANCHORS) | (first_of_pair & pair)

    def around(anchor: Column) -> Column:
        low = F.greatest(anchor - REACH, F.lit(0))
        part = F.slice(words, low + 1, anchor - low + REACH + 1)
        window = F.concat(F.lit(" "), F.array_join(part, "  "), F.lit(" "))
        tried = F.filter(rules, lambda r: F.contains(window, r["need"]) & F.rlike(window, r["pattern"]))
        return F.flatten(F.transform(tried, lambda r: _matches(window, low, anchor, r)))

    def unsuppressed(found: Column) -> Column:
        def contained(d: Column, e: Column) -> Column:
            inside = (e["start"] <= d["start"]) & (d["end"] <= e["end"])
            longer = (e["end"] - e["start"]) > (d["end"] - d["start"])
            return inside & ((e["priority"] > d["priority"]) | ((e["priority"] == d["priority"]) & longer))

        return F.filter(found, lambda d: ~F.exists(found, lambda e: contained(d, e)))

    def first_seen(found: Column, anchor: Column) -> Column:
        """A detection with several anchors is taken at the first of them."""
        return F.filter(found, lambda d: (d["start"] == anchor) | ~F.exists(F.sequence(d["start"], anchor - 1), is_anchor))

    anchors = F.filter(F.sequence(F.lit(0), F.size(words) - 1), is_anchor)
    found = F.transform(anchors, lambda i: F.struct(i.alias("anchor"), around(i).alias("found")))
    each = F.transform(found, lambda f: first_seen(unsuppressed(f["found"]), f["anchor"]))
    return F.when(F.size(words) > 0, F.flatten(each))


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections``.

    Texts are read as lower-case (A to Z) words between ASCII punctuation and space. Only texts that hold a keyword or a pair of anchor
    words go on. There every base phrase is counted at every place, and around every anchor word the signature rules are tried,
    each behind a word it needs. Of detections that contain one another the one of higher priority stays, of equal
    priority the longer. ``labels`` joins base labels and those of the detections that stay; ``score`` is the largest
    weight among them, zero without any.

    A plain projection: no shuffle, no Python. Null texts count as empty and have no words and no labels. Repeated
    rows give repeated results; extra columns are ignored; an empty table gives no rows.
    """
    whole = text_or_empty(text)
    low = F.lower(whole)
    gate = F.contains(low, F.lit("cc")) & low.rlike(CC_GATE)
    for keyword in KEYWORDS:
        gate = gate | F.contains(low, F.lit(keyword))
    for following, firsts in ANCHOR_PAIRS.items():
        gate = gate | (F.contains(low, F.lit(following)) & low.rlike(f"(?:{'|'.join(firsts)}){BETWEEN}{following}"))
    plain = F.trim(F.regexp_replace(F.translate(whole, UPPER, LOWER), SEPARATORS, " "))
    no_words = F.array().cast("array<string>")
    words = F.when(gate & (plain != ""), F.split(plain, " ")).otherwise(no_words)
    read = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.regexp_count(whole, F.lit(WORD)).cast("bigint").alias("n_words"),
        words.alias("words"),
    )
    found = read.select(
        "doc_id",
        "n_words",
        *[_places(F.col("words"), phrase).alias(f"base_{n}") for n, (phrase, _) in enumerate(BASE_PHRASES)],
        _detections(F.col("words"), F.from_json(F.lit(json.dumps(signature_rules())), RULE_TYPE)).alias("detections"),
    )
    places = [F.col(f"base_{n}") for n in range(len(BASE_PHRASES))]
    every = F.concat(*places)
    base = F.array_sort(
        F.array_compact(F.array(*[F.when(F.size(p) > 0, F.lit(label)) for p, (_, label) in zip(places, BASE_PHRASES, strict=True)]))
    )
    kept = F.coalesce(F.col("detections"), F.array().cast(found.schema["detections"].dataType))
    weights = F.concat(F.transform(kept, lambda d: d["weight"]), F.when(F.size(every) > 0, F.array(F.lit(BASE_WEIGHT))).otherwise(F.array(F.lit(0.0))))
    return found.select(
        "doc_id",
        "n_words",
        F.size(every).cast("bigint").alias("n_base"),
        F.array_min(every).cast("bigint").alias("first_word"),
        F.array_max(every).cast("bigint").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.transform(kept, lambda d: d["label"]))), ",").alias("labels"),
        F.array_max(weights).alias("score"),
        kept.alias("detections"),
    )
