import re

import awkward
from conftest import rows
from leasewise.llm import licenses


def plain_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    places = sorted((i, label) for label, phrase in licenses.BASE for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split())
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({p[1] for p in places})))


TEXTS = ["The MIT License", "Ünder the mit-license; THE MIT\nLICENSE. the mit licenses", "Apache License, Version 2.0 and apache license version 2", "CC BY-NC 4.0, cc by nc-sa",
         "a the b mit license", "éthe mit license", "the mit licenseé", "the mit license the mit license"]


def test_base_on_rows_of_any_kind(spark):
    extra = [(100 + i, t, *awkward.DOCS[1][2:]) for i, t in enumerate(TEXTS)]
    got = rows(licenses.license_scan(awkward.docs(spark, awkward.DOCS + extra)), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == sorted([(r[0], *plain_base(r[1])) for r in awkward.DOCS + extra], key=str)
    assert licenses.license_scan(awkward.empty(spark)).count() == 0


def test_base_phrases_are_those_of_the_contract():
    got = lambda text: tuple(licenses.scan(text)[k] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels"))
    assert got("Released under the MIT License.") == (5, 1, 1, 1, "mit")
    assert got("The MIT License (MIT)") == (4, 0, None, None, "") and labels("The MIT License (MIT)") == "mit"
    assert got("Under\nThe MIT-License, not understanding the MIT license; CC BY-NC or under the mit license") == (17, 3, 0, 13, "cc-by-nc,mit")
    assert got("Apache License, Version 2.0, apache license version 20") == (9, 1, 0, 0, "apache-2")


def labels(text):
    return licenses.scan(text)["labels"]


def test_rules_find_their_license():
    assert len(licenses.rules()) > 300
    assert labels("SPDX-License-Identifier: GPL-2.0-or-later") == "gpl-2"
    assert labels("licensed under the GNU Lesser General Public License, version 2.1") == "lgpl-2.1"
    assert labels("see https://www.gnu.org/licenses/agpl-3.0.html") == "agpl-3"
    assert labels("This work is licensed under the GNU General Public License, version 3.") == "gpl-3"
    assert labels("Redistribution and use in source and binary forms, with or without") == "bsd"
    assert labels("Creative Commons Attribution-NonCommercial-ShareAlike") == "cc-by-nc-sa"
    assert labels("Creative Commons Attribution 4.0") == "cc-by"
    assert labels("All rights reserved.") == "proprietary"
    assert labels("permission denied, mitten im Wald, the isc committee met bsd users") == ""


def test_identifiers_of_all_families():
    for label, spdx, *_ in licenses.FAMILIES:
        sample = re.sub(r"\(\?:([^|)]*)[^)]*\)\??", r"\1", spdx.split("|")[0])
        sample = re.sub(r"\[(.)[^\]]*\]", r"\1", sample).replace("\\", "").replace("?", "")
        assert label in labels(f"SPDX-License-Identifier: {sample}").split(","), (label, sample)


def test_keyword_prefilter_loses_nothing():
    """Every detection of every rule also comes through the automaton."""
    text = " . ".join(TEXTS + ["released under the terms of the Mozilla Public License, v. 2.0", "in the public domain", "zlib license", "ISC license", "sil open font license",
                               "neither the name of X nor the names of its contributors"]).lower()
    possible = {i for _, ids in licenses._automaton().iter(text) for i in ids}
    assert all(i in possible for i, r in enumerate(licenses.rules()) if r.pattern.search(text) and "é" not in text)


def test_contained_detections_are_suppressed():
    text = "licensed under the gnu lesser general public license version 2.1"
    (found,) = licenses.detections(text)
    assert found[2].label == "lgpl-2.1" and text[found[0]:found[1]] == text
    kept = licenses.detections("the mit license, the apache license version 2.0, the mit license")
    assert [r.label for _, _, r in kept] == ["mit", "apache-2", "mit"]
    assert all(a[1] <= b[0] for a, b in zip(kept, kept[1:]))


def test_offsets_are_code_points():
    text = "çéü the mit license"
    (found,) = licenses.scan(text)["detections"]
    assert text[found["start"]:found["end"]] == "the mit license"


def test_rules_hold_over_wrapped_lines():
    for gap in ("\n * ", "\n    * ", "\r\n\t\t//   ", "\n#" + " " * 20):
        assert labels(f"Redistribution and use in source and binary{gap}forms, with or without") == "bsd"
        assert labels(f"licensed under the GNU Lesser General{gap}Public License, version 2.1") == "lgpl-2.1"
        assert labels(f"Neither the name of The Example{gap}Company nor the{gap}names of its contributors") == "bsd-3-clause"
