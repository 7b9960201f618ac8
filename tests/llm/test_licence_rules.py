from scenequarry.llm import licence_rules as L

APACHE = 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT ANY.'


def test_scan(spark):
    texts = [
        ("Some prose.\nReleased under the MIT License.\nMore prose.", "MIT"), ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"),
        ("x. Licensed under the Apache License, Version 2.0. y", "Apache-2.0"), (APACHE, "Apache-2.0"), ("LICENSED UNDER CC BY 4.0!\nReleased under the MIT License. Released under the MIT License.", "MIT,CC-BY"),
        ("The licence of the house is old.\nA driving license.", ""), ("", ""), (None, ""), ("word " * 50_000 + "\nReleased under the MIT License.", "MIT"), ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
        ("Not released under the MIT License.", ""),
    ]
    df = spark.createDataFrame([(i, t, "old") for i, (t, _) in enumerate(texts)], "asset_id long, notes string, licences string")
    got = {r.asset_id: ",".join(r.licences) for r in L.scan_notes(df).collect()}
    assert got == {i: w for i, (_, w) in enumerate(texts)}
    assert L.scan_notes(df.limit(0)).collect() == []


def test_ordered_rules_take_their_sentences(spark):
    rules = (L.LicenceRule("long", (1, 2, 3)), L.LicenceRule("part", (2,)), L.LicenceRule("other", (4, 1)))
    known = tuple((i, f"licence {i}") for i in range(1, 5))
    texts = ["licence 1. licence 2. licence 3.", "licence 1. licence 4. licence 2. x. licence 3.", "licence 3. licence 2. licence 1.", "licence 4. licence 1."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "asset_id long, notes string")
    got = {r.asset_id: (r.sentence_ids, r.licences) for r in L.scan_notes(df, known=tuple((i, f.replace(" ", " ")) for i, f in known), rules=rules).collect()}
    assert got == {0: ([1, 2, 3], ["long"]), 1: ([1, 4, 2, 3], ["long"]), 2: ([3, 2, 1], ["part"]), 3: ([4, 1], ["other"])}


def test_query_equals_its_sql(spark, tmp_path):
    import duckdb

    from scenequarry.llm import queries as Q

    texts = [*[t for t, _ in NOTICES if "\n" not in t], APACHE, "Released under the MIT License. Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.", None, "", " \t\n x", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software now", "All rights reserved. version 1.2.3 of the licence; yes"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, Q.QUERIES["op2_license_scan"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(con.execute(Q.ORACLES["op2_license_scan"]).fetchall())


def test_published_wrapped_texts(spark):
    apache = 'Copyright 2020 Some One\n\nLicensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an "AS IS" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n'
    mit = 'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED.'
    gpl = "This program is free software{} you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version {} of the License, or\n(at your option) any later version."
    texts = [
        (apache, "Apache-2.0"), ("# " + apache.replace("\n", "\n# "), "Apache-2.0"), (mit, "MIT"), (gpl.format(":", 3), "GPL-3.0"), (gpl.format(";", 2), "GPL-2.0"),
        ("Licensed under the GNU General Public License, version 2.", "GPL-2.0"), ("Licensed under the GNU General Public License v1", "GPL-1.0"), ("Licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
        ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA"), ("Licensed under CC BY-ND 4.0.", "CC-BY-ND"), ("Some line\nreleased under the\nMIT License\nReleased under CC BY 4.0", "MIT,CC-BY"), ("Released under the\n\nMIT of old", ""),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "asset_id long, notes string")
    got = {r.asset_id: ",".join(r.licences) for r in L.scan_notes(df).collect()}
    assert got == {i: w for i, (_, w) in enumerate(texts)}


BSD = "Copyright (c) 2020, Some One\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice.\n\n{}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\"\nAND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.\n"
NAMES = "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n\n"
NOTICES = [
    (BSD.format(""), "BSD-2-Clause"), ("All rights reserved.", "proprietary"), ("Copyright 2020 X. All rights reserved. Licensed under the MIT License.", "MIT"),
    ("Released under the terms of the CC BY 4.0.", "CC-BY"), ("Released to CC0 1.0", "public-domain"), ("Distributed under the terms of the Creative Commons BY-SA 4.0.", "CC-BY-SA"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY"), ("Licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "CC-BY-NC-SA"),
    ("Licensed under the GNU Affero General Public License, version 3 or later.", "AGPL-3.0"), ("Licensed under the Mozilla Public License 2.0.", "MPL-2.0"), ("Released under the ISC license", "ISC"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.", "MPL-2.0"), ("ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES\nWITH REGARD TO THIS SOFTWARE", "ISC"),
    ("SPDX: BSD-3-Clause", "BSD-3-Clause"), ("// SPDX-License-Identifier: MIT OR Apache-2.0", "MIT,Apache-2.0"), ("/* SPDX-License-Identifier: (GPL-2.0-or-later AND CC-BY-SA-4.0) */", "GPL-2.0,CC-BY-SA"), ("SPDX-License-Identifier: GPL-3.0-only", "GPL-3.0"),
    ("// " + APACHE.replace("\n", "\n// "), "Apache-2.0"), ("//Released under the MIT License.", "MIT"), ("All rights\nreserved", "proprietary"), ("The public library in CC was creative / old.", ""),
]


def test_notices(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NOTICES)], "asset_id long, notes string")
    got = {r.asset_id: ",".join(r.licences) for r in L.scan_notes(df).collect()}
    assert {i: (NOTICES[i][0], got[i]) for i in got} == {i: x for i, x in enumerate(NOTICES)}


def test_numbered_conditions(spark):
    """A condition with its number in front of it is the same sentence."""
    df = spark.createDataFrame([(1, BSD.format(NAMES)), (2, BSD.format(NAMES[3:]))], "asset_id long, notes string")
    assert {r.asset_id: r.licences for r in L.scan_notes(df).collect()} == {1: ["BSD-3-Clause"], 2: ["BSD-3-Clause"]}


def test_every_sentence_holds_a_hint():
    import re

    for number, form in L.SENTENCES:
        for way in form.split("|") if form.startswith("you may obtain") else [form]:
            shown = re.sub(r"\(\?:[^()]*\)\?|\(\?:(?:[^()]|\([^()]*\))*\)\?", " ", way).replace("licen[sc]e", "license").replace("(?:by|attribution)", "by")
            assert re.search(L.HINTS, shown) or re.search(L.HINTS, way), number
