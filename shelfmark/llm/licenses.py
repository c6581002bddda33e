"""License scans: ordered signature rules behind a keyword gate."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import ALNUM, texts, words

# Phrases of the base and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Label, names in running text as a pattern over lower-cased words with single
# blanks, versions as a pattern, and words of which every match of the name has one.
FAMILIES = [
    ("mit", "(?:mit|expat|x11)", "", "mit|expat|x11"),
    ("mit-0", "mit (?:0|no attribution)", "", "mit"),
    ("apache", "(?:apache|asl)(?: software)?", "1 0|1 1|2 0|2", "apache|asl"),
    ("gpl", "(?:gnu )?general public", "1 0|1|2 0|2|3 0|3", "general"),
    ("gpl", "(?:gnu )?gpl(?: ?v)?", "1 0|1|2 0|2|3 0|3", "gpl"),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public", "2 0|2 1|2|3 0|3", "general"),
    ("lgpl", "(?:gnu )?lgpl(?: ?v)?", "2 0|2 1|2|3 0|3", "lgpl"),
    ("agpl", "(?:gnu )?affero general public", "1 0|3 0|3", "affero"),
    ("agpl", "(?:gnu )?agpl(?: ?v)?", "1 0|3 0|3", "agpl"),
    ("gfdl", "(?:gnu )?free documentation", "1 1|1 2|1 3", "documentation"),
    ("bsd", "(?:new|revised|modified|simplified)? ?bsd", "0|1|2|3|4", "bsd"),
    ("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|two clause bsd|freebsd)", "", "bsd"),
    ("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|three clause bsd)", "", "bsd"),
    ("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)", "", "bsd"),
    ("isc", "isc", "", "isc"),
    ("mpl", "mozilla public", "1 0|1 1|2 0", "mozilla"),
    ("epl", "eclipse public", "1 0|2 0", "eclipse"),
    ("edl", "eclipse distribution", "1 0", "eclipse"),
    ("cddl", "common development and distribution", "1 0|1 1", "common"),
    ("cpl", "common public", "1 0", "common"),
    ("cpal", "common public attribution", "1 0", "common"),
    ("eupl", "european union public", "1 0|1 1|1 2", "european"),
    ("cecill", "cecill(?: [bc])?", "1 0|1 1|2 0|2 1", "cecill"),
    ("artistic", "(?:perl )?artistic", "1 0|2 0", "artistic"),
    ("zlib", "zlib(?: libpng)?", "", "zlib"),
    ("libpng", "libpng", "1 0|2 0", "libpng"),
    ("boost", "boost software", "1 0", "boost"),
    ("python", "(?:python software foundation|psf|python)", "2 0|2", "python|psf"),
    ("php", "php", "3 0|3 01|3 1", "php"),
    ("ruby", "ruby", "", "ruby"),
    ("postgresql", "postgresql", "", "postgresql"),
    ("openssl", "openssl", "", "openssl"),
    ("unlicense", "(?:the )?unlicense", "", "unlicense"),
    ("wtfpl", "wtfpl|do what the fuck you want to public", "1|2", "wtfpl|fuck"),
    ("cc0", "(?:creative commons zero|cc0|cc zero)", "1 0", "creative|cc"),
    ("cc-by", "(?:creative commons attribution|cc by)", "1 0|2 0|2 5|3 0|4 0", "creative|cc"),
    ("cc-by-sa", "(?:creative commons attribution share ?alike|cc by sa)", "1 0|2 0|2 5|3 0|4 0", "creative|cc"),
    ("cc-by-nc", "(?:creative commons attribution non ?commercial|cc by nc)", "1 0|2 0|2 5|3 0|4 0", "creative|cc"),
    ("cc-by-nd", "(?:creative commons attribution no ?deriv(?:ative)?s?|cc by nd)", "1 0|2 0|2 5|3 0|4 0", "creative|cc"),
    ("ofl", "(?:sil )?open font", "1 0|1 1", "font"),
    ("odbl", "(?:open data commons )?open database", "1 0", "database"),
    ("osl", "open software", "1 0|2 0|2 1|3 0", "software"),
    ("afl", "academic free", "1 1|1 2|2 0|2 1|3 0", "academic"),
    ("ms-pl", "microsoft public", "", "microsoft"),
    ("ms-rl", "microsoft reciprocal", "", "microsoft"),
    ("ncsa", "(?:university of illinois )?ncsa(?: open source)?", "", "ncsa"),
    ("sspl", "server side public", "1|1 0", "server"),
    ("busl", "business source", "1 0|1 1", "business"),
    ("elastic", "elastic", "1 0|2 0", "elastic"),
    ("vim", "vim", "", "vim"),
]

# What may stand around a name: kind, priority, pattern.
TEMPLATES = [
    ("tag", 100, r"spdx license identifier {name}(?: ?(?P<v>{versions}))?(?: only| or later)?"),
    ("grant", 90, r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?{name}(?: license)?(?:(?: version| v)? ?(?P<v>{versions}))?(?: only| or (?:any )?later)?"),
    ("subject", 80, r"subject to (?:the )?(?:terms of (?:the )?)?{name} license(?:(?: version| v)? ?(?P<v>{versions}))?"),
    ("version", 70, r"{name} license(?:(?: version| v)? ?(?P<v>{versions}))"),
    ("file", 60, r"see (?:the )?{name} license"),
    ("name", 50, r"{name} license"),
]

#: Priority of the template that needs a version; the other templates do without.
VERSIONED = 70
_VERSION = re.compile(r"\(\?:(?:\(\?: version\| v\)\?)? \?\(\?P<v>\{versions\}\)\)\??")

# Signatures of license texts, not of names.
TEXTS = [
    ("mit", 85, "permission is hereby granted free of charge to any person obtaining a copy", "hereby"),
    ("isc", 85, "permission to use copy modify and or distribute this software for any purpose with or without fee", "permission"),
    ("bsd", 85, "redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("zlib", 85, "this software is provided as is without any express or implied warranty", "warranty"),
    ("unlicense", 85, "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("public-domain", 60, "(?:released|placed|dedicated) (?:in|into|to) the public domain", "domain"),
    ("proprietary", 40, "all rights reserved", "reserved"),
]


class Rule(NamedTuple):
    label: str
    priority: int
    pattern: re.Pattern
    keywords: tuple[str, ...]
    versioned: bool


def rules() -> list[Rule]:
    """Every template around every name, then the text signatures; some three hundred."""
    found = []
    for label, name, versions, needed in FAMILIES:
        for _, priority, template in TEMPLATES:
            if not versions:
                if priority == VERSIONED:
                    continue
                template = _VERSION.sub("", template)
            pattern = rf"\b(?:{template.format(name=f'(?:{name})', versions=versions)})\b"
            found.append(Rule(label, priority, re.compile(pattern), tuple(needed.split("|")), bool(versions) and "(?P<v>" in template))
    found += [Rule(label, priority, re.compile(rf"\b(?:{p})\b"), (word,), False) for label, priority, p, word in TEXTS]
    return found


def gate(all_rules: list[Rule]) -> ahocorasick.Automaton:
    """Keywords with the numbers of the rules that need one of them."""
    by_word: dict[str, list[int]] = {}
    for k, rule in enumerate(all_rules):
        for word in rule.keywords:
            by_word.setdefault(word, []).append(k)
    found = ahocorasick.Automaton()
    for word, numbers in by_word.items():
        found.add_word(word, tuple(numbers))
    found.make_automaton()
    return found


#: Any text that a rule or the base can match has one of these.
_NEEDED = tuple(sorted({b"licens", b"spdx", b"under", b"subject", b"hereby", b"permission", b"redistribution", b"warranty", b"domain", b"reserved"}))


class Detection(NamedTuple):
    start: int
    end: int
    label: str
    priority: int


def detect(line: str, all_rules: list[Rule], keywords: ahocorasick.Automaton) -> list[Detection]:
    """Matches of the rules of which a keyword occurs in the line, in words (end excluded). A match
    inside another of the same or higher priority, or inside a longer one of the same label's
    family, is suppressed; of equal spans the rule of higher priority, then the earlier, stays."""
    numbers = {k for _, ks in keywords.iter(line) for k in ks}
    blanks = [m.start() for m in re.finditer(" ", line)]
    raw = []
    for k in sorted(numbers):
        rule = all_rules[k]
        for m in rule.pattern.finditer(line):
            version = m.groupdict().get("v") if rule.versioned else None
            label = f"{rule.label}-{version.replace(' ', '.')}" if version else rule.label
            raw.append((Detection(bisect_right(blanks, m.start()), bisect_right(blanks, m.end() - 1) + 1, label, rule.priority), k))
    raw.sort(key=lambda x: (x[0].start, -x[0].end, -x[0].priority, x[1]))
    kept: list[Detection] = []
    reach: list[Detection] = []
    for found, _ in raw:
        reach = [r for r in reach if r.end > found.start]
        inside = any(r.end >= found.end and (r.priority >= found.priority or r.end - r.start > found.end - found.start) for r in reach)
        if not inside:
            kept.append(found)
            reach.append(found)
    return kept


def base_places(line: str) -> tuple[list[int], set[str]]:
    """Word numbers at which a base phrase begins, and the labels found. `line` has blanks at
    both ends."""
    places, labels = [], set()
    for phrase, label in BASE.items():
        at = line.find(f" {phrase} ")
        while at >= 0:
            places.append(line.count(" ", 0, at))
            labels.add(label)
            at = line.find(f" {phrase} ", at + 1)
    return places, labels


def scan(docs: DataFrame) -> DataFrame:
    """A row for each document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, spans (start, end in words, label).

    Words are runs of digits, letters a-z after lower-casing A-Z, and characters beyond ASCII,
    of the whole text; a null text is empty. labels has the base's and the rules'. score is one
    less the product of what each detection leaves open (its priority in percent; a base phrase
    50). Nothing found: empty strings, null places, score 0. Repeated rows and rows without
    doc_id are scanned each for itself; other columns are ignored. An empty table gives none."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_rules = rules()
        keywords = gate(all_rules)
        for batch in batches:
            rows: list[tuple] = []
            for _, data, offsets in texts(batch):
                raw = data.tobytes()
                starts, ends, first = words(data, offsets, ALNUM)
                for k in range(len(offsets) - 1):
                    a, b = int(first[k]), int(first[k + 1])
                    text = raw[offsets[k] : offsets[k + 1]]
                    if not any(w in text for w in _NEEDED):
                        rows.append((b - a, 0, None, None, "", "", 0.0, []))
                        continue
                    spaced = b" ".join([raw[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)])
                    line = spaced.decode("utf-8", "replace")
                    places, base = base_places(f" {line} ")
                    found = detect(line, all_rules, keywords)
                    left = 0.5 ** len(base)
                    for d in found:
                        left *= 1 - min(d.priority, 99) / 100
                    labels = base | {d.label for d in found}
                    rows.append((
                        b - a, len(places), min(places, default=None), max(places, default=None),
                        ",".join(sorted(base)), ",".join(sorted(labels)), 1 - left if labels else 0.0,
                        [{"start": d.start, "end": d.end, "label": d.label} for d in found],
                    ))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names)

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        of_batches, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, spans array<struct<start:bigint,end:bigint,label:string>>",
    )
