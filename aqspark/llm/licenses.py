"""License scan by ordered signature rules.

A text is lower-cased for A-Z and cut into words of digits, a-z and characters beyond ASCII; rules are regular expressions over the words joined by
blanks. Each rule has a keyword: a rule is tried only if the text has that word. Rules are ordered by priority (phrases to be counted, identifiers, addresses,
grants, names, families, mentions). Detections are resolved in that order: one that lies within a detection of a better priority, or within a longer one of the
same priority, is suppressed. The phrases to be counted (``BASE``) are never suppressed.

Spans are offsets of words and code points in the original text. The score is one minus the product of the chances that each kept kind of detection is wrong.
A null or empty text has no words and no detections, and scores 0. Ties (equal spans and priority) go to the label that is first in the alphabet. Repeated rows
are scanned alike and get a row each. Long texts are scanned whole: every rule is linear in the text. An empty table gives no rows. Columns other
than the id and the text are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aqspark.llm.common import batches, byte_rows
from aqspark.llm.contamination import NORMAL

# Phrases that are counted wherever their words stand consecutively
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

PRIORITY = ("base", "identifier", "address", "grant", "name", "family", "mention")
#: How likely a detection of a kind is right.
TRUST = {"base": 0.95, "identifier": 0.99, "address": 0.9, "grant": 0.95, "name": 0.8, "family": 0.6, "mention": 0.3}

# label: (keyword of its names, names, words of its identifier, words of its address). Names are regular expressions over words.
LICENSES: dict[str, tuple[str, str, str, str]] = {
    "mit": ("mit|expat", r"(?:the )?mit (?:x11 )?licen[sc]e|mit licensed|expat licen[sc]e", "mit", "opensource org licenses mit"),
    "mit-0": ("attribution", r"mit no attribution(?: licen[sc]e)?", "mit 0", "opensource org license mit 0"),
    "apache-1.1": ("apache", r"apache (?:software )?licen[sc]e (?:version |v )?1 1", "apache 1 1", "apache org licenses license 1 1"),
    "apache-2": ("apache", r"apache (?:software )?licen[sc]e(?: version | v ?| )2(?: 0)?|apache 2(?: 0)? licen[sc]ed?", "apache 2 0", "apache org licenses license 2 0"),
    "bsd-2-clause": ("bsd", r"(?:simplified|freebsd|2 clause|two clause) bsd licen[sc]e|bsd 2 clause(?: licen[sc]e)?", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    "bsd-3-clause": ("bsd", r"(?:new|modified|revised|3 clause|three clause) bsd licen[sc]e|bsd 3 clause(?: licen[sc]e)?", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    "bsd-4-clause": ("bsd", r"(?:original|old|4 clause|four clause) bsd licen[sc]e|bsd 4 clause(?: licen[sc]e)?", "bsd 4 clause", "spdx org licenses bsd 4 clause"),
    "0bsd": ("bsd", r"(?:zero clause|0 clause|free public) bsd(?: licen[sc]e)?|bsd zero clause(?: licen[sc]e)?", "0bsd", "opensource org licenses 0bsd"),
    "isc": ("isc", r"(?:the )?isc licen[sc]e", "isc", "opensource org licenses isc"),
    "gpl-1": ("gpl|gplv1|general", r"(?:gnu )?(?:gpl|general public licen[sc]e)(?: version | v ?| )1(?: 0)?|gplv1", "gpl 1 0(?: only| or later)?", "gnu org licenses old licenses gpl 1 0"),
    "gpl-2": ("gpl|gplv2|general", r"(?:gnu )?(?:gpl|general public licen[sc]e)(?: version | v ?| )2(?: 0)?|gplv2", "gpl 2 0(?: only| or later)?", "gnu org licenses (?:old licenses )?gpl 2 0"),
    "gpl-3": ("gpl|gplv3|general", r"(?:gnu )?(?:gpl|general public licen[sc]e)(?: version | v ?| )3(?: 0)?|gplv3", "gpl 3 0(?: only| or later)?", "gnu org licenses gpl 3 0"),
    "lgpl-2": ("lgpl|lgplv2|library", r"(?:gnu )?(?:lgpl|library general public licen[sc]e)(?: version | v ?| )2(?: 0)?|lgplv2", "lgpl 2 0(?: only| or later)?", "gnu org licenses (?:old licenses )?lgpl 2 0"),
    "lgpl-2.1": ("lgpl|lgplv2|lesser", r"(?:gnu )?(?:lgpl|lesser general public licen[sc]e)(?: version | v ?| )2 1|lgplv2 1", "lgpl 2 1(?: only| or later)?", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    "lgpl-3": ("lgpl|lgplv3|lesser", r"(?:gnu )?(?:lgpl|lesser general public licen[sc]e)(?: version | v ?| )3(?: 0)?|lgplv3", "lgpl 3 0(?: only| or later)?", "gnu org licenses lgpl 3 0"),
    "agpl-3": ("agpl|agplv3|affero", r"(?:gnu )?(?:agpl|affero general public licen[sc]e)(?: version | v ?| )3(?: 0)?|agplv3", "agpl 3 0(?: only| or later)?", "gnu org licenses agpl 3 0"),
    "gfdl-1.2": ("gfdl|documentation", r"(?:gfdl|(?:gnu )?free documentation licen[sc]e)(?: version | v ?| )1 2", "gfdl 1 2(?: only| or later)?", "gnu org licenses (?:old licenses )?fdl 1 2"),
    "gfdl-1.3": ("gfdl|documentation", r"(?:gfdl|(?:gnu )?free documentation licen[sc]e)(?: version | v ?| )1 3", "gfdl 1 3(?: only| or later)?", "gnu org licenses fdl 1 3"),
    "mpl-1.1": ("mpl|mozilla", r"(?:mpl|mozilla public licen[sc]e)(?: version | v ?| )1 1", "mpl 1 1", "mozilla org mpl 1 1"),
    "mpl-2": ("mpl|mozilla", r"(?:mpl|mozilla public licen[sc]e)(?: version | v ?| )2(?: 0)?", "mpl 2 0", "mozilla org mpl 2 0"),
    "epl-1": ("epl|eclipse", r"(?:epl|eclipse public licen[sc]e)(?: version | v ?| )1(?: 0)?", "epl 1 0", "eclipse org legal epl v10"),
    "epl-2": ("epl|eclipse", r"(?:epl|eclipse public licen[sc]e)(?: version | v ?| )2(?: 0)?", "epl 2 0", "eclipse org legal epl (?:2 0|v20)"),
    "edl-1": ("eclipse", r"eclipse distribution licen[sc]e(?: version| v)?(?: 1 0)?", "edl 1 0", "eclipse org org documents edl v10"),
    "cddl-1": ("cddl|distribution", r"(?:cddl|common development and distribution licen[sc]e)(?: version | v ?| )1(?: 0)?", "cddl 1 0", "opensource org licenses cddl 1 0"),
    "cddl-1.1": ("cddl|distribution", r"(?:cddl|common development and distribution licen[sc]e)(?: version | v ?| )1 1", "cddl 1 1", "glassfish java net public cddl gpl 1 1"),
    "cpl-1": ("common", r"common public licen[sc]e(?: version| v)?(?: 1 0)?", "cpl 1 0", "opensource org licenses cpl 1 0"),
    "cpal-1": ("attribution", r"common public attribution licen[sc]e(?: version| v)?(?: 1 0)?", "cpal 1 0", "opensource org licenses cpal 1 0"),
    "ibm-public-1": ("ibm", r"ibm public licen[sc]e(?: version| v)?(?: 1 0)?", "ipl 1 0", "opensource org licenses ipl 1 0"),
    "artistic-1": ("artistic", r"(?:the )?artistic licen[sc]e(?: version| v)? 1(?: 0)?", "artistic 1 0(?: perl| cl8)?", "opensource org licenses artistic 1 0"),
    "artistic-2": ("artistic", r"(?:the )?artistic licen[sc]e(?: version| v)? 2(?: 0)?", "artistic 2 0", "opensource org licenses artistic 2 0"),
    "bsl-1": ("boost", r"boost software licen[sc]e(?: version| v)?(?: 1 0)?", "bsl 1 0", "boost org license 1 0"),
    "busl-1.1": ("business", r"business source licen[sc]e(?: version| v)?(?: 1 1)?", "busl 1 1", "mariadb com bsl11"),
    "unlicense": ("unlicense", r"(?:the )?unlicense", "unlicense", "unlicense org"),
    "wtfpl": ("wtfpl|fuck", r"wtfpl|do what the fuck you want to public licen[sc]e", "wtfpl", "wtfpl net"),
    "zlib": ("zlib", r"(?:the )?zlib(?: libpng)? licen[sc]e", "zlib", "opensource org licenses zlib"),
    "libpng": ("libpng", r"(?:the )?libpng licen[sc]e", "libpng", "libpng org pub png src libpng license"),
    "curl": ("curl", r"(?:the )?curl licen[sc]e", "curl", "curl se docs copyright"),
    "openssl": ("openssl", r"(?:the )?openssl licen[sc]e", "openssl", "openssl org source license"),
    "ncsa": ("ncsa|illinois", r"(?:university of illinois|university of illinois ncsa|ncsa) open source licen[sc]e", "ncsa", "opensource org licenses ncsa"),
    "postgresql": ("postgresql", r"(?:the )?postgresql licen[sc]e", "postgresql", "opensource org licenses postgresql"),
    "psf-2": ("python|psf", r"python software foundation licen[sc]e(?: version| v)?(?: 2(?: 0)?)?|psf licen[sc]e", "(?:psf|python) 2 0", "docs python org 3 license"),
    "ruby": ("ruby", r"(?:the )?ruby licen[sc]e", "ruby", "ruby lang org en about license"),
    "php-3": ("php", r"(?:the )?php licen[sc]e(?: version| v)?(?: 3(?: 0[01])?)?", "php 3 0 ?1?", "php net license 3 01"),
    "perl": ("perl", r"same terms as perl(?: itself)?", "artistic 1 0 perl or gpl 1 0", "dev perl org licenses"),
    "ofl-1.1": ("font", r"(?:sil )?open font licen[sc]e(?: version| v)?(?: 1 1)?", "ofl 1 1", "scripts sil org ofl"),
    "eupl-1.2": ("eupl|european", r"(?:eupl|european union public licen[sc]e)(?: version| v)?(?: 1 2)?", "eupl 1 2", "joinup ec europa eu .{0,40}eupl"),
    "cecill-2.1": ("cecill", r"cecill(?: free software)? licen[sc]e(?: agreement)?(?: version| v)?(?: 2 1)?", "cecill 2 1", "cecill info licences"),
    "ms-pl": ("microsoft", r"microsoft public licen[sc]e", "ms pl", "opensource org licenses ms pl"),
    "ms-rl": ("microsoft", r"microsoft reciprocal licen[sc]e", "ms rl", "opensource org licenses ms rl"),
    "osl-3": ("osl|open", r"open software licen[sc]e(?: version| v)?(?: 3 0)?", "osl 3 0", "opensource org licenses osl 3 0"),
    "afl-3": ("academic", r"academic free licen[sc]e(?: version| v)?(?: 3 0)?", "afl 3 0", "opensource org licenses afl 3 0"),
    "upl-1": ("upl|universal", r"universal permissive licen[sc]e(?: version| v)?(?: 1 0)?", "upl 1 0", "oss oracle com licenses upl"),
    "mulan-2": ("mulan", r"mulan (?:psl|permissive software licen[sc]e)(?:(?: version | v ?| )2)?", "mulanpsl 2 0", "license coscl org cn mulanpsl2"),
    "elastic-2": ("elastic", r"elastic licen[sc]e(?: version| v)?(?: 2(?: 0)?)?", "elastic 2 0", "elastic co licensing elastic license"),
    "sspl-1": ("sspl|server", r"(?:sspl|server side public licen[sc]e)(?:(?: version | v ?| )1)?", "sspl 1 0", "mongodb com licensing server side public license"),
    "cc0-1": ("cc0|creative", r"cc0(?: 1 0)?(?: universal)?|creative commons zero(?: v?1 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero 1 0"),
    "cc-by": ("cc|creative", r"cc by(?: [1-4] [05])?|creative commons attribution(?: [1-4] [05])?(?: international| unported)?(?: licen[sc]e)?", "cc by [1-4] [05]", "creativecommons org licenses by [1-4] [05]"),
    "cc-by-sa": ("cc|creative", r"cc by sa(?: [1-4] [05])?|creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)?(?: licen[sc]e)?", "cc by sa [1-4] [05]", "creativecommons org licenses by sa [1-4] [05]"),
    "cc-by-nd": ("cc|creative", r"cc by nd(?: [1-4] [05])?|creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international)?(?: licen[sc]e)?", "cc by nd [1-4] [05]", "creativecommons org licenses by nd [1-4] [05]"),
    "cc-by-nc": ("cc|creative", r"cc by nc(?: [1-4] [05])?|creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported)?(?: licen[sc]e)?", "cc by nc [1-4] [05]", "creativecommons org licenses by nc [1-4] [05]"),
    "cc-by-nc-sa": ("cc|creative", r"cc by nc sa(?: [1-4] [05])?|creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported)?(?: licen[sc]e)?", "cc by nc sa [1-4] [05]", "creativecommons org licenses by nc sa [1-4] [05]"),
    "cc-by-nc-nd": ("cc|creative", r"cc by nc nd(?: [1-4] [05])?|creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international)?(?: licen[sc]e)?", "cc by nc nd [1-4] [05]", "creativecommons org licenses by nc nd [1-4] [05]"),
    "pddl-1": ("pddl|dedication", r"(?:pddl|(?:open data commons )?public domain dedication and licen[sc]e)(?: v?1 0)?", "pddl 1 0", "opendatacommons org licenses pddl"),
    "odc-by-1": ("odc|commons", r"odc by|open data commons attribution licen[sc]e(?: v?1 0)?", "odc by 1 0", "opendatacommons org licenses by"),
    "odbl-1": ("odbl|database", r"(?:odbl|(?:open data commons )?open database licen[sc]e)(?: v?1 0)?", "odbl 1 0", "opendatacommons org licenses odbl"),
    "ogl-3": ("government", r"open government licen[sc]e(?:(?: version | v ?| )3(?: 0)?)?", "ogl uk 3 0", "nationalarchives gov uk doc open government licence version 3"),
}
# label: (keyword, words) of families whose version is not given, and of phrases that mention terms without naming them
FAMILIES: dict[str, tuple[str, str]] = {
    "gpl": ("gpl|general", r"gnu gpl|gpl|gnu general public licen[sc]e"), "lgpl": ("lgpl|lesser", r"lgpl|(?:gnu )?lesser general public licen[sc]e"),
    "agpl": ("agpl|affero", r"agpl|(?:gnu )?affero general public licen[sc]e"), "gfdl": ("gfdl|documentation", r"gfdl|(?:gnu )?free documentation licen[sc]e"),
    "bsd": ("bsd", r"bsd (?:style )?licen[sc]ed?"), "apache": ("apache", r"apache (?:software )?licen[sc]e"), "mpl": ("mozilla", r"mozilla public licen[sc]e"),
    "epl": ("eclipse", r"eclipse public licen[sc]e"), "artistic": ("artistic", r"artistic licen[sc]e"), "creative-commons": ("creative", r"creative commons(?: licen[sc]e)?"),
    "public-domain": ("domain", r"(?:released (?:in)?to|placed in|in|dedicated to) the public domain|public domain"),
}
MENTIONS: dict[str, tuple[str, str]] = {
    "all-rights-reserved": ("reserved", r"all rights reserved"), "proprietary": ("proprietary|confidential", r"proprietary and confidential|confidential and proprietary"),
    "permission-grant": ("permission", r"permission is hereby granted free of charge|permission to use copy modify and(?: or)? distribute"),
    "redistribution": ("redistribution", r"redistribution and use in source and binary forms"), "no-warranty": ("warranty", r"provided as is without warranty|without warranty of any kind"),
    "non-commercial": ("commercial|noncommercial", r"(?:for )?non ?commercial (?:use|purposes)(?: only)?|not for commercial use"), "license-file": ("license|licence|copying", r"see (?:the )?(?:file )?(?:licen[sc]e|copying)(?: txt| md)?(?: file)? for (?:more )?(?:details|information|terms|licen[sc]e)"),
}
_GRANT = r"(?:(?:dual |re)?licensed|released|distributed|available|published|provided|covered|shared|offered|made available|governed by|use is subject to)(?: to you)?(?: under| by| subject to)?(?: the)?(?: terms)?(?: and conditions)?(?: of)?(?: the)?(?: an?)? "


@dataclass(frozen=True)
class Rule:
    kind: str
    label: str
    keywords: frozenset[bytes]
    pattern: re.Pattern


def _rule(kind: str, label: str, keywords: str, words: str) -> Rule:
    return Rule(kind, label, frozenset(k.encode() for k in keywords.split("|")), re.compile(rf"(?<![^ ])(?:{words})(?![^ ])".encode()))


def rules() -> list[Rule]:
    """All rules, best priority first."""
    out = [_rule("base", label, phrase.split()[0] if label != "mit" else "mit", phrase) for phrase, label in BASE.items()]
    for label, (keyword, name, identifier, address) in LICENSES.items():
        out += [
            _rule("identifier", label, "spdx", rf"spdx licen[sc]e identifier {identifier}"),
            _rule("address", label, address.split()[0], address),
            _rule("grant", label, keyword, rf"{_GRANT}(?:{name})"),
            _rule("name", label, keyword, name),
        ]
    out += [_rule("family", label, keyword, words) for label, (keyword, words) in FAMILIES.items()]
    out += [_rule("mention", label, keyword, words) for label, (keyword, words) in MENTIONS.items()]
    return sorted(out, key=lambda r: PRIORITY.index(r.kind))


RULES = rules()
KEYWORDS: dict[bytes, list[int]] = {}
for _i, _r in enumerate(RULES):
    for _k in _r.keywords:
        KEYWORDS.setdefault(_k, []).append(_i)
_ALL = frozenset(KEYWORDS)


def candidates(words: list[bytes], joined: bytes) -> list[tuple[int, int, int]]:
    """(begin, end, rule) of every match in the joined words, of the rules whose keyword the text has."""
    present = _ALL.intersection(words)
    tried = sorted({i for k in present for i in KEYWORDS[k]})
    return [(m.start(), m.end(), i) for i in tried for m in RULES[i].pattern.finditer(joined)]


def resolve(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The detections that no better one contains, in the order of the text; one sweep for each priority."""
    kept: list[tuple[int, int, int]] = []
    for kind in PRIORITY:
        own = sorted((x for x in found if RULES[x[2]].kind == kind), key=lambda x: (x[0], -x[1], RULES[x[2]].label))
        if kind != "base":
            kept.sort()
            begins, furthest = [x[0] for x in kept], list(accumulate((x[1] for x in kept), max))
            longest, outer = -1, []
            for a, b, i in own:
                at = bisect_right(begins, a)
                if b > longest and not (at and furthest[at - 1] >= b):
                    outer.append((a, b, i))
                longest = max(longest, b)
            own = outer
        kept += own
    return sorted(kept, key=lambda x: (x[0], x[1], RULES[x[2]].label))


_WORD = re.compile(rb"[^ ]+")


def scan_text(text: bytes) -> tuple[int, list[tuple[int, int, int, int, int]]]:
    """The number of words, and detections: first word, word after the last, code points likewise, rule."""
    clean = text.translate(NORMAL)
    words = clean.split()
    if _ALL.isdisjoint(words):
        return len(words), []
    joined = b" ".join(words)
    kept = resolve(candidates(words, joined))
    if not kept:
        return len(words), []
    blanks = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    first = np.searchsorted(blanks, [a for a, _, _ in kept])
    last = np.searchsorted(blanks, [b for _, b, _ in kept])
    places = np.array([m.span() for m in _WORD.finditer(clean)])
    point = np.concatenate(([0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)))
    return len(words), [(int(a), int(b) + 1, int(point[places[a][0]]), int(point[places[b][1]]), i) for a, b, (_, _, i) in zip(first, last, kept)]


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``detections`` (words, code points, kind, label) and ``score`` of each row."""
    kind = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("label", pa.string())]))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, "text"):
            n, found, score = [], [], []
            for x in byte_rows(batch.column("text")):
                count, kept = scan_text(x)
                n.append(count)
                found.append([(a, b, c, d, RULES[i].kind, RULES[i].label) for a, b, c, d, i in kept])
                doubt = 1.0
                for k in sorted({RULES[i].kind for *_, i in kept}):
                    doubt *= 1 - TRUST[k]
                score.append(1 - doubt)
            spans = pa.array([[dict(zip(("first", "after", "start", "end", "kind", "label"), y)) for y in x] for x in found], kind)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), spans, pa.array(score, pa.float64())], names=["doc_id", "n_words", "detections", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_kind = rows.schema["doc_id"].dataType.simpleString()
    struct = "struct<first: long, after: long, start: long, end: long, kind: string, label: string>"
    return rows.mapInArrow(run, f"doc_id {id_kind}, n_words long, detections array<{struct}>, score double")
