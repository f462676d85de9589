"""License scans: ordered signature rules behind a keyword prefilter.

A text is lower-cased (A-Z) once; one pass of a keyword automaton finds which
rules can match at all, only those are tried, and overlapping detections are
settled by priority and containment.
"""

from __future__ import annotations

import re
from bisect import bisect, insort
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import by_text

# Base phrases: label and the words that stand consecutively.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))

# Texts are bytes read as Latin-1, so every byte from \x80 on belongs to a word.
IN, OUT = r"[0-9a-z\x80-\xff]", r"[\x00-\x2f\x3a-\x60\x7b-\x7f]"
G = "(?:" + OUT + "+)"  # a gap between two words of a signature: also line ends with comment leaders and indents

# label, SPDX identifier, name, address; each part is a regex over lower-case
# text, "_" stands for a gap; last come the keywords, one of which must occur.
FAMILIES = (
    ("mit", r"mit", r"(?:the_)?(?:mit|expat)_licen[sc]e", r"opensource\.org/licenses/mit(?![\w-])", "mit|expat"),
    ("mit-0", r"mit-0", r"mit_no_attribution", r"opensource\.org/licenses/mit-0", "mit-0|no attribution"),
    ("apache-1.1", r"apache-1\.1", r"apache_(?:software_)?licen[sc]e_v(?:ersion)?_?1_1", r"apache\.org/licenses/license-1\.1", "apache"),
    ("apache-2", r"apache-2\.0", r"apache_(?:software_)?licen[sc]e(?:_v(?:ersion)?)?_?2", r"apache\.org/licenses/license-2\.0", "apache"),
    ("gpl-1", r"gpl-1\.0(?:-only|-or-later|\+)?", r"(?:gnu_)?(?:gpl|general_public_licen[sc]e)_v(?:ersion)?_?1(?!\d)", r"gnu\.org/licenses/old-licenses/gpl-1", "gpl|general public"),
    ("gpl-2", r"gpl-2\.0(?:-only|-or-later|\+)?", r"(?:gnu_)?(?:gpl|general_public_licen[sc]e)_v(?:ersion)?_?2(?!\d)", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2", "gpl|general public"),
    ("gpl-3", r"gpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu_)?(?:gpl|general_public_licen[sc]e)_v(?:ersion)?_?3(?!\d)", r"gnu\.org/licenses/gpl-3", "gpl|general public"),
    ("gpl", r"gpl", r"gnu_(?:gpl|general_public_licen[sc]e)", r"gnu\.org/(?:licenses/gpl(?![-\w])|copyleft/gpl)", "gpl|general public"),
    ("lgpl-2", r"lgpl-2\.0(?:-only|-or-later|\+)?", r"(?:gnu_)?(?:lgpl|library_general_public_licen[sc]e)_v(?:ersion)?_?2(?!\d|_1)", r"gnu\.org/licenses/old-licenses/lgpl-2\.0", "lgpl|library general"),
    ("lgpl-2.1", r"lgpl-2\.1(?:-only|-or-later|\+)?", r"(?:gnu_)?(?:lgpl|lesser_general_public_licen[sc]e)_v(?:ersion)?_?2_1", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1", "lgpl|lesser general"),
    ("lgpl-3", r"lgpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu_)?(?:lgpl|lesser_general_public_licen[sc]e)_v(?:ersion)?_?3(?!\d)", r"gnu\.org/licenses/lgpl-3", "lgpl|lesser general"),
    ("lgpl", r"lgpl", r"gnu_(?:lgpl|(?:lesser|library)_general_public_licen[sc]e)", r"gnu\.org/(?:licenses/lgpl(?![-\w])|copyleft/lesser)", "lgpl|lesser general|library general"),
    ("agpl-1", r"agpl-1\.0(?:-only|-or-later)?", r"affero_general_public_licen[sc]e_v(?:ersion)?_?1", r"affero\.org/oagpl", "agpl|affero"),
    ("agpl-3", r"agpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu_)?(?:agpl|affero_general_public_licen[sc]e)_v(?:ersion)?_?3(?!\d)", r"gnu\.org/licenses/agpl-3", "agpl|affero"),
    ("agpl", r"agpl", r"(?:gnu_)?affero_(?:general_public_licen[sc]e|gpl)", r"gnu\.org/licenses/agpl(?![-\w])", "agpl|affero"),
    ("gfdl", r"gfdl-1\.[123](?:-only|-or-later)?", r"gnu_free_documentation_licen[sc]e", r"gnu\.org/(?:licenses|copyleft)/fdl", "gfdl|free documentation|/fdl"),
    ("bsd-2-clause", r"bsd-2-clause", r"(?:simplified_bsd|free_?bsd|(?:2|two)_clause_bsd|bsd_(?:2|two)_clause)(?:_licen[sc]e)?", r"opensource\.org/licenses/bsd-2-clause", "bsd"),
    ("bsd-3-clause", r"bsd-3-clause", r"(?:(?:new|modified|revised|3_clause|three_clause)_bsd|bsd_(?:3|three)_clause)(?:_licen[sc]e)?", r"opensource\.org/licenses/bsd-3-clause", "bsd"),
    ("bsd-4-clause", r"bsd-4-clause", r"(?:original_bsd|(?:4|four)_clause_bsd|bsd_(?:4|four)_clause)(?:_licen[sc]e)?", r"spdx\.org/licenses/bsd-4-clause", "bsd"),
    ("0bsd", r"0bsd", r"(?:zero_clause|0_clause)_bsd(?:_licen[sc]e)?", r"opensource\.org/licenses/0bsd", "bsd"),
    ("bsd", r"bsd", r"bsd_(?:style_)?licen[sc]e", r"opensource\.org/licenses/bsd-license", "bsd"),
    ("isc", r"isc", r"isc_licen[sc]e", r"opensource\.org/licenses/isc", "isc"),
    ("zlib", r"zlib", r"zlib(?:_libpng)?_licen[sc]e", r"zlib\.net/zlib_license|opensource\.org/licenses/zlib", "zlib"),
    ("libpng", r"libpng(?:-2\.0)?", r"libpng_licen[sc]e", r"libpng\.org/pub/png/src/libpng-license", "libpng"),
    ("boost-1", r"bsl-1\.0", r"boost_software_licen[sc]e", r"boost\.org/license_1_0", "bsl-1|boost"),
    ("bsl-1.1", r"busl-1\.1", r"business_source_licen[sc]e", r"mariadb\.com/bsl11", "busl|business source|bsl11"),
    ("mpl-1.1", r"mpl-1\.1", r"mozilla_public_licen[sc]e_v(?:ersion)?_?1", r"mozilla\.org/mpl/1\.1|mozilla\.org/mpl/mpl-1", "mpl|mozilla"),
    ("mpl-2", r"mpl-2\.0(?:-no-copyleft-exception)?", r"mozilla_public_licen[sc]e_v(?:ersion)?_?2", r"mozilla\.org/(?:en-us/)?mpl/2\.0", "mpl|mozilla"),
    ("mpl", r"mpl", r"mozilla_public_licen[sc]e", r"mozilla\.org/mpl(?!/[12])", "mpl|mozilla"),
    ("epl-1", r"epl-1\.0", r"eclipse_public_licen[sc]e_v(?:ersion)?_?1", r"eclipse\.org/legal/epl-v10", "epl|eclipse"),
    ("epl-2", r"epl-2\.0", r"eclipse_public_licen[sc]e_v(?:ersion)?_?2", r"eclipse\.org/legal/epl-(?:v20|2\.0)", "epl|eclipse"),
    ("epl", r"epl", r"eclipse_public_licen[sc]e", r"eclipse\.org/legal/epl(?!-)", "epl|eclipse"),
    ("cddl-1", r"cddl-1\.[01]", r"common_development_and_distribution_licen[sc]e", r"opensource\.org/licenses/cddl", "cddl|common development"),
    ("cpl-1", r"cpl-1\.0", r"common_public_licen[sc]e", r"opensource\.org/licenses/cpl", "cpl|common public"),
    ("eupl-1.1", r"eupl-1\.1", r"european_union_public_licen[sc]e_v(?:ersion)?_?1_1", r"eupl/licence-eupl-v1\.1", "eupl|european union public"),
    ("eupl-1.2", r"eupl-1\.2", r"european_union_public_licen[sc]e(?:_v(?:ersion)?_?1_2)?", r"eupl/licence-eupl-v1\.2", "eupl|european union public"),
    ("cecill-2.1", r"cecill-2\.1", r"cecill_(?:free_software_)?licen[sc]e", r"cecill\.info/licences", "cecill"),
    ("artistic-1", r"artistic-1\.0(?:-perl|-cl8)?", r"artistic_licen[sc]e_v?(?:ersion_)?1", r"opensource\.org/licenses/artistic-license-1", "artistic"),
    ("artistic-2", r"artistic-2\.0", r"artistic_licen[sc]e_v?(?:ersion_)?2", r"opensource\.org/licenses/artistic-license-2", "artistic"),
    ("artistic", r"artistic", r"artistic_licen[sc]e", r"perl\.com/language/misc/artistic", "artistic"),
    ("psf-2", r"psf-2\.0|python-2\.0", r"python_software_foundation_licen[sc]e|psf_licen[sc]e", r"python\.org/(?:\d[\d.]*/)?license", "psf|python"),
    ("php-3", r"php-3\.0[1]?", r"php_licen[sc]e", r"php\.net/license", "php"),
    ("ruby", r"ruby", r"ruby_licen[sc]e", r"ruby-lang\.org/[a-z]+/about/license", "ruby"),
    ("ofl-1.1", r"ofl-1\.1(?:-rfn|-no-rfn)?", r"(?:sil_)?open_font_licen[sc]e", r"scripts\.sil\.org/ofl", "ofl|open font"),
    ("unlicense", r"unlicense", r"(?:the_)?unlicen[sc]e", r"unlicense\.org", "unlicen"),
    ("wtfpl", r"wtfpl", r"do_what_the_f\S{1,3}_you_want_to_public_licen[sc]e", r"wtfpl\.net", "wtfpl|do what the"),
    ("cc0-1", r"cc0-1\.0", r"cc0|creative_commons_zero", r"creativecommons\.org/publicdomain/zero", "cc0|commons zero|publicdomain/zero"),
    ("cc-by", r"cc-by-[1234]\.[05]", r"(?:cc_by|creative_commons_attribution)(?!_(?:nc|nd|sa|non|no_d|share))", r"creativecommons\.org/licenses/by/", "cc|creative"),
    ("cc-by-sa", r"cc-by-sa-[1234]\.[05]", r"cc_by_sa|creative_commons_attribution_share_?alike", r"creativecommons\.org/licenses/by-sa/", "cc|creative"),
    ("cc-by-nc", r"cc-by-nc-[1234]\.[05]", r"(?:cc_by_nc|creative_commons_attribution_non_?commercial)(?!_(?:sa|nd|share|no_d))", r"creativecommons\.org/licenses/by-nc/", "cc|creative"),
    ("cc-by-nc-sa", r"cc-by-nc-sa-[1234]\.[05]", r"cc_by_nc_sa|creative_commons_attribution_non_?commercial_share_?alike", r"creativecommons\.org/licenses/by-nc-sa/", "cc|creative"),
    ("cc-by-nd", r"cc-by-nd-[1234]\.[05]", r"cc_by_nd|creative_commons_attribution_no_?deriv\w+", r"creativecommons\.org/licenses/by-nd/", "cc|creative"),
    ("cc-by-nc-nd", r"cc-by-nc-nd-[1234]\.[05]", r"cc_by_nc_nd|creative_commons_attribution_non_?commercial_no_?deriv\w+", r"creativecommons\.org/licenses/by-nc-nd/", "cc|creative"),
    ("odbl-1", r"odbl-1\.0", r"open_(?:data_commons_open_)?database_licen[sc]e", r"opendatacommons\.org/licenses/odbl", "odbl|database licen"),
    ("odc-by-1", r"odc-by-1\.0", r"open_data_commons_attribution_licen[sc]e", r"opendatacommons\.org/licenses/by", "odc|open data commons"),
    ("pddl-1", r"pddl-1\.0", r"public_domain_dedication_and_licen[sc]e", r"opendatacommons\.org/licenses/pddl", "pddl|domain dedication"),
    ("ncsa", r"ncsa", r"(?:university_of_illinois_)?ncsa_(?:open_source_)?licen[sc]e", r"opensource\.org/licenses/ncsa", "ncsa"),
    ("postgresql", r"postgresql", r"postgresql_licen[sc]e", r"postgresql\.org/about/licence", "postgresql"),
    ("openssl", r"openssl", r"openssl_licen[sc]e", r"openssl\.org/source/license", "openssl"),
    ("ms-pl", r"ms-pl", r"microsoft_public_licen[sc]e", r"opensource\.org/licenses/ms-pl", "ms-pl|microsoft public"),
    ("ms-rl", r"ms-rl", r"microsoft_reciprocal_licen[sc]e", r"opensource\.org/licenses/ms-rl", "ms-rl|microsoft reciprocal"),
    ("sspl-1", r"sspl-1\.0", r"server_side_public_licen[sc]e", r"mongodb\.com/licensing/server-side-public-license", "sspl|server side public|server-side-public"),
    ("elastic-2", r"elastic-2\.0", r"elastic_licen[sc]e(?:_v?2)?", r"elastic\.co/licensing/elastic-license", "elastic"),
    ("upl-1", r"upl-1\.0", r"universal_permissive_licen[sc]e", r"opensource\.org/licenses/upl", "upl|universal permissive"),
    ("osl-3", r"osl-3\.0", r"open_software_licen[sc]e", r"opensource\.org/licenses/osl-3", "osl|open software"),
    ("afl-3", r"afl-3\.0", r"academic_free_licen[sc]e", r"opensource\.org/licenses/afl-3", "afl|academic free"),
    ("vim", r"vim", r"vim_licen[sc]e", r"vimhelp\.org/uganda", "vim"),
    ("blueoak-1", r"blueoak-1\.0\.0", r"blue_oak_model_licen[sc]e", r"blueoakcouncil\.org/license", "blueoak|blue oak"),
    ("mulan-2", r"mulanpsl-2\.0", r"mulan_(?:permissive_software_licen[sc]e|psl)", r"license\.coscl\.org\.cn/mulanpsl2", "mulan"),
    ("openrail-m", r"openrail-m|(?:creativeml|bigscience)-openrail-m", r"(?:creativeml_|bigscience_)?(?:bloom_)?(?:open_)?rail_?(?:m_)?licen[sc]e", r"licenses\.ai/", "rail|licenses.ai"),
)

# Rules without a family: priority, label, score, regex, keyword.
LOOSE = (
    (1, "mit", 0.95, r"permission_is_hereby_granted_free_of_charge_to_any_person_obtaining_a_copy", "permission is hereby"),
    (1, "isc", 0.95, r"permission_to_use_copy_modify_and_or_distribute_this_software_for_any_purpose", "permission to use"),
    (1, "bsd", 0.9, r"redistribution_and_use_in_source_and_binary_forms", "redistribution and use"),
    (2, "bsd-3-clause", 0.9, r"neither_the_names?_of_(?s:.){1,200}?_nor_the_names_of_its_contributors", "neither the name"),
    (1, "unlicense", 0.95, r"this_is_free_and_unencumbered_software_released_into_the_public_domain", "unencumbered"),
    (1, "zlib", 0.9, r"this_software_is_provided_as_is_without_any_express_or_implied_warranty_in_no_event", "express or implied"),
    (1, "boost-1", 0.95, r"boost_software_licen[sc]e_version_1_0_august_17th_2003", "august 17th"),
    (2, "gpl", 0.85, r"free_software_you_can_redistribute_it_and_or_modify_it_under_the_terms_of_the_gnu", "can redistribute"),
    (5, "public-domain", 0.6, r"(?:released|placed|dedicated)_(?:in)?to_the_public_domain", "public domain"),
    (5, "public-domain", 0.5, r"in_the_public_domain", "public domain"),
    (6, "proprietary", 0.7, r"all_rights_reserved", "rights reserved"),
    (6, "proprietary", 0.7, r"proprietary_and_confidential", "confidential"),
    (6, "proprietary", 0.6, r"(?:may|must)_not_be_(?:copied|reproduced|redistributed)_without", "without"),
    (7, "unknown", 0.3, r"(?:licen[sc]ed|released)_under_(?:the_)?terms", "terms"),
)


@dataclass(frozen=True)
class Rule:
    priority: int  # the smallest wins
    label: str
    score: float
    pattern: re.Pattern
    keywords: tuple[str, ...]  # one of them must occur


def _compiled(body: str) -> re.Pattern:
    return re.compile(f"(?<!{IN})(?:" + body.replace("_", G) + f")(?!{IN})")


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules in order: identifier tags, addresses, notices, names, in brackets or badges, then loose ones."""
    made = []
    for label, spdx, name, url, words in FAMILIES:
        keys = tuple(words.split("|"))
        made += [
            Rule(0, label, 1.0, _compiled(rf"spdx_licen[sc]e_identifier_(?:{spdx})"), ("spdx",)),
            Rule(1, label, 0.95, re.compile(url.replace("_", "[_]")), ("http", "www.", ".org", ".com", ".net", ".info", ".ai", ".co", ".cn", "eupl/")),
            Rule(2, label, 0.9, _compiled(rf"(?:licen[sc]ed|released|distributed|published|available|provided)_under_(?:the_)?(?:terms_of_)?(?:the_)?(?:{name})"), keys),
            Rule(3, label, 0.8, _compiled(rf"licen[sc]e(?:_type|_name)?_(?:{spdx})"), keys),
            Rule(4, label, 0.6, _compiled(name), keys),
        ]
    made += [Rule(p, label, score, _compiled(body), (key,)) for p, label, score, body, key in LOOSE]
    return tuple(sorted(made, key=lambda r: r.priority))


@lru_cache(maxsize=1)
def _automaton():
    """Keyword automaton; a keyword's words may be apart by any one sign, so it looks for its longest word."""
    wanted: dict[str, set[int]] = {}
    for i, rule in enumerate(rules()):
        for key in rule.keywords:
            longest = max(key.split(), key=len)
            wanted.setdefault(longest, set()).add(i)
    machine = ahocorasick.Automaton()
    for word, ids in wanted.items():
        machine.add_word(word, tuple(sorted(ids)))
    machine.make_automaton()
    return machine


def detections(low: str) -> list[tuple[int, int, Rule]]:
    """(start, end, rule) kept in a lower-case text, in order of place.

    By priority, then length, then place: a detection that overlaps one
    already kept, so also one contained in it, is suppressed.
    """
    possible = sorted({i for _, ids in _automaton().iter(low) for i in ids})
    every = rules()
    found = [(every[i].priority, m.start() - m.end(), m.start(), i) for i in possible for m in every[i].pattern.finditer(low)]
    kept: list[tuple[int, int, Rule]] = []
    starts: list[tuple[int, int]] = []
    for _, minus, start, i in sorted(found):
        end = start - minus
        at = bisect(starts, (start, end))
        if (at and starts[at - 1][1] > start) or (at < len(starts) and starts[at][0] < end):
            continue
        insort(starts, (start, end))
        kept.append((start, end, every[i]))
    return sorted(kept, key=lambda d: d[0])


_WORD = re.compile(f"{IN}+")
_PHRASES = [(label, label.split("-")[0],  # a rare word of the phrase, looked for first
             re.compile(f"(?<!{IN})" + f"{OUT}+".join(words.split()) + f"(?!{IN})")) for label, words in BASE]


def scan(text: str | None) -> dict:
    """Counts, base places and detections of one text, null as empty."""
    low = (text or "").encode("utf-8", "surrogatepass").lower().decode("latin-1")  # bytes: A-Z only
    words = len(_WORD.findall(low))
    places = [(m.start(), label) for label, key, pattern in _PHRASES if key in low for m in pattern.finditer(low)]
    word_at = lambda start: len(_WORD.findall(low, 0, start))
    kept = detections(low)
    base = {label for _, label in places}
    return {
        "n_words": words, "n_base": len(places),
        "first_word": word_at(min(places)[0]) if places else None, "last_word": word_at(max(places)[0]) if places else None,
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | {r.label for _, _, r in kept})),
        "score": max([r.score for _, _, r in kept] + [0.6] * bool(places), default=0.0),
        # bytes back to code points
        "detections": [{"label": r.label, "start": len(low[:s].encode("latin-1").decode("utf-8", "replace")),
                        "end": len(low[:e].encode("latin-1").decode("utf-8", "replace")), "score": r.score} for s, e, r in kept],
    }


TYPES = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(),
         "labels": pa.string(), "score": pa.float64(),
         "detections": pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))}
SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "detections array<struct<label: string, start: bigint, end: bigint, score: double>>")


def license_scan(docs: DataFrame, keep: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: words, base places and labels, all labels, score, detections.

    `score` is the best score of a kept detection, 0 without one.  Detections
    carry code-point offsets.  Null and empty texts have no words, empty
    labels and null first and last places; repeated rows are scanned each.
    """
    def run(texts: list[str | None]) -> dict[str, pa.Array]:
        made = [scan(t) for t in texts]
        return {c: pa.array([m[c] for m in made], t) for c, t in TYPES.items()}

    return by_text(docs, [keep], text, SCHEMA, run)
