"""Archives, URL filters and licences against plain Python."""

import gzip
import hashlib
import io
import struct
import textwrap
import zipfile

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import licences, url_filter, zip_warc
from sparkmart.llm.queries import URL_RULES


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, type string, lang string")


def test_archive_round_trip(spark):
    big, other = "<p>same</p>" * 20, "é" * 60
    rows = [(5, "http://a/\r\nX: y", big, "t", "x"), (2, "http://b", big, "t", "x"), (2, "http://b", big, "t", "x"), (9, None, big, "t", None),
            (3, "u", "small", None, "x"), (4, "u", "small", "t", "x"), (6, "u", None, "t", "x"), (7, "u", "", "t", "x"), (8, "u", other, "t", "x"),
            (None, "u", other, "t", "x"), (11, "long", "long text " * 200_000, "t", "x")]
    got = sorted(((r["page"], r["type"], r["refers_to"], r["payload_bytes"], r["declared"], r["payload"]) for r in zip_warc.round_trip(pages(spark, rows)).collect()), key=str)
    want = []
    for page, _, html, _, _ in rows:
        raw = (html or "").encode()
        first = {big: 2, other: 8}.get(html, page)
        again = page != first
        want.append((None if page is None else str(page), "revisit" if again else "response", str(first) if again else None, len(raw), hashlib.sha256(raw).hexdigest(), None if again else raw))
    assert got == sorted(want, key=str)
    assert zip_warc.round_trip(pages(spark, [])).count() == 0


def test_several_packages_and_foreign_ones(spark, tmp_path):
    """Packages of another writer: a comment at the end, other members, a data member without an index."""
    rows = zip_warc.marked(pages(spark, [(i, "u", f"page {i}" * 50, "t", "x") for i in range(30)]), "page_id", "url", "html")
    packages = zip_warc.write_packages(rows, f"file://{tmp_path}/own", most=500)
    assert packages.count() > 1 and packages.agg(F.sum("records")).first()[0] == 30
    foreign = tmp_path / "foreign.wacz"
    with zipfile.ZipFile(foreign, "w") as z:
        z.writestr("datapackage.json", "{}", zipfile.ZIP_DEFLATED)
        body = b"".join(gzip.compress(zip_warc.record(str(i), "u", b"p" * i, "0", None, False, "2024-01-01T00:00:00Z")) for i in (100, 101, 102))
        z.writestr("archive/x.warc.gz", body)
        z.comment = b"a comment PK\x05\x06 with a mark"
    both = packages.select("uri").union(spark.createDataFrame([(f"file://{foreign}",)], "uri string"))
    assert sorted(int(r["page"]) for r in zip_warc.read_records(both).collect()) == [*range(30), 100, 101, 102]


def test_zip64_directory(tmp_path):
    """A directory whose sizes, places and counts are in ZIP64 fields."""
    data = gzip.compress(zip_warc.record("1", "u", b"payload", "0", None, False, "2024-01-01T00:00:00Z"))
    name = b"archive/data.warc.gz"
    wide = struct.pack("<HHQQ", 1, 16, len(data), len(data))
    local = b"PK\x03\x04" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(wide)) + name + wide
    lead = b"x" * 10
    extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), len(lead))
    entry = b"PK\x01\x02" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    at = len(lead) + len(local) + len(data)
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, at + len(entry), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    path = tmp_path / "wide.wacz"
    path.write_bytes(lead + local + data + entry + end64 + locator + end)
    with pafs.LocalFileSystem().open_input_file(str(path)) as file:
        (member,) = zip_warc.members(file)
        start = zip_warc.data_start(file, member)
        file.seek(start)
        assert member["size"] == len(data) and zip_warc.parsed(gzip.decompress(file.read(member["size"])))["payload"] == b"payload"


def test_damage_is_told(tmp_path):
    (tmp_path / "no.wacz").write_bytes(b"nothing here")
    with pafs.LocalFileSystem().open_input_file(str(tmp_path / "no.wacz")) as file, pytest.raises(ValueError):
        list(zip_warc.members(file))
    deflated = io.BytesIO()
    with zipfile.ZipFile(deflated, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a", "x" * 100)
    (tmp_path / "d.wacz").write_bytes(deflated.getvalue())
    with pafs.LocalFileSystem().open_input_file(str(tmp_path / "d.wacz")) as file, pytest.raises(ValueError):
        zip_warc.data_start(file, next(iter(zip_warc.members(file))))


URLS = [
    None, "", "no scheme", "http://", "http://NET", "http://net/", "http://a.net/x", "http://anet/", "https://EXAMPLE.net/en/1?x=/en/", "http://example.net/en",
    "http://b.example.net/en/", "http://example.com/de/", "ftp://x.y.example.com/de/q#/", "http://w.org/fr/", "http://org/fr/a", "http://org.x/fr/", "x://a://b.net/",
    "http://u@example.net:80/en/", "http://example.net?/en/", "http://É.net/\n/en/", "http://a..net/x", "http://" + "a." * 300 + "net/" + "x/" * 500,
]


def verdict(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = rest[:cut].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [(len(h + p), h + p, a) for h, p, a in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fit)[1], max(fit)[2]) if fit else (host, path, None, "allow")


def test_urls(spark):
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, action string")
    rows = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(4, "http://NET", "x", "y"), (None, "http://a.net/", None, "y")], "page_id long, url string, Host string, found string")
    out = url_filter.verdicts(rows, rules)
    assert out.columns == ["page_id", "url", "found", "host", "path", "rule", "verdict"]
    got = out.collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == verdict(r["url"]), r["url"]
    assert url_filter.verdicts(rows, rules.limit(0)).where("verdict <> 'allow'").count() == 0
    assert url_filter.verdicts(rows.limit(0), rules).count() == 0


def test_rules_without_a_slash_and_ties(spark):
    rules = spark.createDataFrame([("a.net", "/en", "allow"), ("net", "/eng", "block"), ("b.net", "/", "allow"), ("b.net", "/", "block"), (None, "/", "block")], "host string, path string, action string")
    rows = spark.createDataFrame([("http://a.net/english",), ("http://b.net/",)], "url string")
    assert [r["verdict"] for r in url_filter.verdicts(rows, rules).orderBy("url").collect()] == ["allow", "block"]


def test_licences(spark):
    apache = 'x.\n// Licensed under the Apache License, Version 2.0 (the "License");\n// you may not use this file except in compliance with the License.\n// You may obtain a copy of the License at\n//   http://www.apache.org/licenses/LICENSE-2.0\n'
    rows = [
        (1, "Prose here. Released under the MIT License.\nAll rights reserved."), (2, "Released under the MIT\nlicense!"), (3, "released under the mit licence."),
        (4, None), (5, ""), (6, "you may not use this file except in compliance with the License."), (1, "Licensed under CC BY-NC 4.0."),
        (1, "Licensed under CC BY-NC 4.0."), (None, "LICENSED UNDER CC BY-NC 4.0"), (7, apache), (8, "word " * 50_000 + ".\nReleased under the MIT License."),
    ]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, licences string, name string")
    got = sorted(((r["id"], r["licences"], r["n_known"], r["n_unmatched"]) for r in licences.recognised(table).collect()), key=str)
    want = [
        (1, "MIT", 2, 0), (2, "MIT", 1, 0), (3, "", 0, 0), (4, "", 0, 0), (5, "", 0, 0), (6, "", 1, 1), (1, "CC-BY-NC-4.0", 1, 0),
        (1, "CC-BY-NC-4.0", 1, 0), (None, "CC-BY-NC-4.0", 1, 0), (7, "Apache-2.0", 3, 0), (8, "MIT", 1, 0),
    ]
    assert got == sorted(want, key=str)
    assert licences.recognised(table.limit(0)).count() == 0


def test_every_known_sentence_is_recognised(spark):
    table = spark.createDataFrame([(i, f"Some text. {s}. More text.") for i, (_, s) in enumerate(licences.SENTENCES)], "doc_id long, text string")
    known = {r["id"]: r["n_known"] for r in licences.recognised(table).collect()}
    assert all(n >= 1 for n in known.values())


def test_standard_notices_are_recognised(spark):
    """Notices as they stand in files, with their usual line ends."""
    gpl = "{} is free software{} you can redistribute it and/or modify\nit under the terms of the GNU {} License as published by\nthe Free Software Foundation{} either version {} of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.\n"
    notices = {
        "MIT": 'Copyright (c) 2020 A B\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice shall be included.\n',
        "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by law.\n',
        "GPL-3.0-or-later": gpl.format("This program", ":", "General Public", ",", 3),
        "GPL-2.0-or-later": gpl.format("This program", ";", "General Public", ";", 2),
        "AGPL-3.0-or-later": gpl.format("This program", ":", "Affero General Public", ",", 3),
        "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.\n",
        "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n* Redistributions of source code must retain the above copyright notice, this\n  list of conditions and the following disclaimer.\n\n* Redistributions in binary form must reproduce the above copyright notice,\n  this list of conditions and the following disclaimer in the documentation\n  and/or other materials provided with the distribution.\n\nThe end.\n",
        "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n",
        "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.\n",
        "Unlicense": "This is free and unencumbered software released into the public domain.\n",
        "CC0-1.0": "Creative Commons Legal Code\n\nCC0 1.0 Universal\n\n",
    }
    table = spark.createDataFrame(list(notices.items()), "doc_id string, text string")
    got = {r["id"]: (r["licences"], r["n_unmatched"]) for r in licences.recognised(table).collect()}
    assert got == {name: (name, 0) for name in notices}
    title = spark.createDataFrame([(1, "MIT License\n\nCopyright (c) 2020 A B\n")], "doc_id long, text string")
    assert licences.recognised(title).first()["licences"] == "MIT"


#: Notices as sentences and paragraphs, to be wrapped at any width. Wording of the notices.
WRAPPED = {
    "MIT": ["MIT License", "Copyright (c) 2020 A B. All rights reserved.", licences.SENTENCES[[n for n, _ in licences.SENTENCES].index("mit-whole")][1], "The above copyright notice shall be included."],
    "Apache-2.0": ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at', "http://www.apache.org/licenses/LICENSE-2.0", "Unless required by law."],
    "GPL-3.0-or-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
                         "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."],
    "BSD-3-Clause": ["Copyright (c) 2020, A B", "All rights reserved.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
                     "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
                     "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
                     "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "ISC": ["Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
}


def test_licences_at_any_width_and_comment_mark(spark):
    """Ten widths, five comment marks, with and without empty lines between paragraphs."""
    rows = []
    for name, paragraphs in WRAPPED.items():
        for width in (36, 44, 52, 60, 64, 70, 76, 80, 100, 10_000):
            for mark in ("", "# ", " * ", ";; ", "// "):
                for gap in ("\n", "\n" + mark.rstrip() + "\n"):
                    text = gap.join(textwrap.fill(p, width, initial_indent=mark, subsequent_indent=mark) for p in paragraphs)
                    rows.append((f"{name} {width} {mark!r} {gap!r}", text + "\n", name))
    table = spark.createDataFrame(rows, "doc_id string, text string, name string")
    got = {r["id"]: r["licences"] for r in licences.recognised(table).collect()}
    assert {k: v for k, v in got.items() if v != k.split(" ")[0]} == {} and len(got) == len(rows)


def test_licence_words_of_other_texts(spark):
    many = "\n".join(["All Rights"] * 2000)
    rows = [
        ("spdx", "// SPDX-License-Identifier: Apache-2.0\nimport x"), ("title", "MIT License\nCopyright A B\n"), ("inside", "Released under the\nMIT License\nCopyright A B"),
        ("version", "This work is licensed under the GNU General Public License, version\n3. All else."), ("reserved", "all rights\nreserved"), ("lines", many),
        ("upper", "RELEASED\nUNDER THE\nMIT LICENSE"), ("other", "Permission\n\nis hereby granted"),
    ]
    table = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r["id"]: (r["licences"], r["n_known"]) for r in licences.recognised(table).collect()}
    assert got == {
        "spdx": ("Apache-2.0", 1), "title": ("MIT", 1), "inside": ("MIT", 1), "version": ("GPL-3.0-only", 1), "reserved": ("Proprietary", 1), "lines": ("", 0),
        "upper": ("MIT", 1), "other": ("", 0),
    }
