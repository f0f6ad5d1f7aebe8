"""License signatures written by hand, on the notices and names people write."""

import re

import pytest

from paceline.llm import license_signatures, licenses


def scan(text):
    return licenses.scan_line(b" %s " % b" ".join(text.encode().translate(licenses._SPACED).split()))


GPL_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General
Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."""
SAID = {
    "GPLv3": "gpl-3", "GPLv2+": "gpl-2", "LGPLv2.1": "lgpl-2.1", "AGPLv3": "agpl-3", "BSD-3-Clause": "bsd-3-clause", "MS-PL": "ms-pl",
    "http://www.apache.org/licenses/LICENSE-2.0": "apache-2", "LGPL2": "lgpl-2", "GNU GPLv3 or later": "gpl-3", "Apache2": "apache-2",
    GPL_NOTICE.format("", "3"): "gpl-3", GPL_NOTICE.format("", "2"): "gpl-2", GPL_NOTICE.format("Lesser ", "2.1"): "lgpl-2.1",
    GPL_NOTICE.format("Library ", "2"): "lgpl-2", GPL_NOTICE.format("Affero ", "3"): "agpl-3",
    "This is free and unencumbered software released into the public domain.": "unlicense",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2",
    "GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007": "gpl-3",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products": "bsd-3-clause",
    "the New BSD License": "bsd-3-clause", "Simplified BSD license": "bsd-2-clause", "0BSD": "0bsd", "SSPL": "sspl-1", "BUSL-1.1": "busl-1.1",
    "The Software shall be used for Good, not Evil.": "json", "Attribution-ShareAlike 4.0 International": "cc-by-sa-4",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.": "ofl-1.1",
    "Apache License v2.0 with LLVM Exceptions": "apache-2-llvm",
    "governed by the CeCILL-B license under French law": "cecill-b",
    "made available under the terms of the Eclipse Public License v2.0": "epl-2",
    "same terms as Perl itself": "", "under the same terms as Perl itself": "perl",
}


@pytest.mark.parametrize("text", SAID)
def test_said(text):
    assert scan(text).labels == SAID[text]


def test_apache_header_keeps_the_base_label_once():
    out = scan("""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy at http://www.apache.org/licenses/LICENSE-2.0""")
    assert (out.labels, out.base_labels, out.n_base) == ("apache-2", "apache-2", 1) and out.score > 0.99


def test_plain_prose_has_no_label():
    for text in ["The members met in 3 rooms; 2 of them spoke of public art.", "bsd 3 people", "an open door and a boost of 10 percent",
                 "attribution of the painting to a pupil", "She was given permission to use the garden."]:
        assert scan(text).labels == "", text


def test_signatures_are_many_distinct_and_gated():
    rows = [row for group, _, _ in license_signatures.GROUPS for row in group]
    assert len(rows) > 200 and len({(label, pattern) for label, _, pattern in rows}) == len(rows)
    for label, gate, pattern in rows:
        re.compile(pattern)
        assert gate and all(word == " ".join(word.split()) for word in gate.split("|")), label
