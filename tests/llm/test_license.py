"""Scans against comparing every window with every template."""

from texts import PROSE, awkward, empty

from revtide.llm import license
from revtide.llm.queries import op7_license_windows


def plain(text, least=0.8):
    scanner, tokens = license.Scanner(license.TEMPLATES), license.words(text)
    found = {}
    for t in scanner.templates:
        for window in range(max(0, (len(tokens) - 4) // t.segment + 1)):
            share, _ = scanner.containment(tokens, t, window)
            if share >= least:
                found[t.name] = max(share, found.get(t.name, 0))
    return found


def test_equals_all_windows(spark, sf_dir):
    docs = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs += [" ".join([PROSE] * k + [text] + [PROSE]) for k, text in enumerate(license.TEMPLATES.values())]
    mit = license.TEMPLATES["MIT-text"].split()
    docs += [" ".join(mit[:40] + ["really"] + mit[40:]), " ".join(mit[:30]), None, ""]
    found = license.Scanner(license.TEMPLATES).scan(docs)
    assert [{n: c for n, c, *_ in own} for own in found] == [plain(d) for d in docs]
    assert sum(map(len, found)) > len(license.TEMPLATES)
    alone = license.Scanner(license.TEMPLATES)
    assert [alone.scan([d])[0] for d in docs] == found


def test_awkward_rows(spark):
    rows = awkward(spark)
    assert license.scanned(rows).count() == rows.count()
    assert license.listed(rows).count() == 0 == license.listed(empty(spark)).count()


def test_reworded_notices(spark):
    notices = {
        "Licensed under the MIT License": ["MIT"], "Distributed under the MIT license.": ["MIT"],
        "MIT Licence": ["MIT"], "licensed under CC BY-NC-SA 4.0": ["CC-BY-NC-SA-4.0"], "Apache License 2.0": ["Apache-2.0"],
        "Licensed under Apache-2.0": ["Apache-2.0"], "the GNU GPL v2 applies": ["GPL-2.0"], "under the GPLv3 license": ["GPL-3.0"],
        "GNU Lesser General Public License, version 2.1": ["LGPL-2.1"], "BSD 3-Clause License": ["BSD-3-Clause"],
        "Mozilla Public License Version 2.0": ["MPL-2.0"], "CC0 1.0 Universal": ["CC0-1.0"],
        "Eclipse Public License - v 2.0": ["EPL-2.0"], "the zlib license": ["Zlib"], "Boost Software License 1.0": ["BSL-1.0"],
        "# SPDX-License-Identifier: MIT": ["MIT"],
        "// SPDX-License-Identifier: GPL-2.0-or-later OR BSD-2-Clause": ["BSD-2-Clause", "GPL-2.0"],
        "Creative Commons Attribution-NonCommercial 3.0 Unported": ["CC-BY-NC-3.0"],
        "He studied at MIT under a famous teacher and got his license": [], "the apache 2.0 server": [],
        "Released under the MIT License.": ["MIT"],
    }
    rows = spark.createDataFrame(list(enumerate(notices)), "doc_id long, text string")
    found = {i: [] for i in range(len(notices))}
    for r in license.listed(rows).orderBy("doc_id", "license").collect():
        found[r["doc_id"]].append(r["license"])
    assert dict(zip(notices, found.values())) == notices


BSD_3 = "Neither the name of the holder nor the names may be used to endorse or promote products derived from this software"


def test_one_id_per_license():
    scanner = license.Scanner(license.TEMPLATES)
    named = {t.name: t for t in scanner.templates}
    parts = license.TEMPLATES
    bsd, gpl, lgpl = parts["BSD-conditions"], parts["GPL-header"], parts["LGPL-header"]
    wanted = {
        bsd + " 1. Redistributions of source code": {"BSD-2-Clause"}, bsd + " 1. source code 3. " + BSD_3: {"BSD-3-Clause"},
        f"{bsd} x {PROSE} {bsd} y {BSD_3}": {"BSD-2-Clause", "BSD-3-Clause"}, BSD_3: set(),
        f"{bsd} {PROSE * 9} {BSD_3}": {"BSD-2-Clause"},
        parts["Apache-2.0-header"]: {"Apache-2.0"}, parts["MIT-text"] + " " + parts["MIT"]: {"MIT"},
        gpl: {"GPL-3.0"}, gpl.replace("version 3", "version 2"): {"GPL-2.0"},
        parts["GPL-3.0"].replace("version 3", "version 2"): {"GPL-2.0"},
        lgpl + "; either version 2.1 of the License": {"LGPL-2.1"}, lgpl + "; either version 3": {"LGPL-3.0"}, lgpl: set(),
    }
    for text, licenses in wanted.items():
        (own,) = scanner.scan([text])
        found = license.stated(text, own, named, license.MIN_CONTAINMENT)
        assert {name for name, *_ in found} == licenses, text
        assert len(found) == len(licenses) and all(share >= 0.8 for _, share, *_ in found)


def test_query_equals_every_window(spark, sf_dir):
    wanted = set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        names = {license.STATES.get(n, n) for n in plain(r["text"])}
        assert not names & (set(license.VARIANTS) - {"GPL-3.0"})
        wanted |= {(r["doc_id"], n) for n in names | set(license.short_notices(r["text"]))}
    rows = op7_license_windows(spark, sf_dir).collect()
    assert len(rows) == len(wanted) and {(r["doc_id"], r["license"]) for r in rows} == wanted
    assert wanted
