import pytest

from tabspark.llm import licenses
from tabspark.llm.q_license import op4_license_rules
from tabspark.plans.oracle_check import compare, duckdb_connection
from tabspark.llm import queries

SF = "/root/testdata/sf0.001"
MIT = ("The MIT License (MIT)\n\nThe above copyright notice and this permission notice shall be included in all "
       "copies or substantial portions of the Software.")
GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
       "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
       "option) any later version.")
COPY = "You should have received a copy of the GNU General Public License along with this program."


@pytest.mark.parametrize("text, names, status", [
    (None, [], "none"), ("", [], "none"), ("\n.;\n ?  ", [], "none"), ("no licence here", [], "none"),
    ("abc.\nReleased under the MIT License.\nabc", ["MIT"], "matched"),
    ("RELEASED!! UNDER!! THE!! MIT!! LICENSE.!!\nabc", ["MIT"], "matched"),
    ("Licensed&&& under*** the$$$ Apache### License,%%% Version&&& 2.0.***", ["Apache-2.0"], "matched"),
    (MIT, ["MIT"], "matched"),
    (f"{GPL}\n{COPY}", ["GPL-3.0-or-later"], "matched"),
    (f"{COPY}\n{GPL}", [], "unmatched"),  # the rule's order
    (f"{GPL}\nAll rights reserved. {COPY}", ["GPL-3.0-or-later", "LicenseRef-reserved"], "matched"),
    ("x " * 200_000 + "\nAll rights reserved.\nLicensed under CC BY-NC 4.0.\nAll rights reserved.",
     ["CC-BY-NC-4.0", "LicenseRef-reserved"], "matched"),
])
def test_rules(make_docs, text, names, status):
    r = licenses.recognise(make_docs([text, text], extra=True)).collect()
    assert len(r) == 2
    assert all(x.licenses == names and x.status == status for x in r)


def test_empty_table_and_null_ids(make_docs):
    assert licenses.recognise(make_docs([])).count() == 0
    assert licenses.recognise(make_docs([(None, MIT), (None, MIT)])).count() == 2


def test_every_table_sentence_is_found(make_docs):
    names = list(licenses.SENTENCES)
    got = licenses.recognise(make_docs([licenses.SENTENCES[n] + "." for n in names])).collect()
    assert {r.doc_id: r.sentence_ids for r in got} == {i: [n] for i, n in enumerate(names)}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    r = compare(spark, SF, name, queries.queries()[name], queries.oracle_sql()[name], duckdb_connection(SF))
    assert r["rows_match"] and r["schema_match"] and r["hash_match"], r


def test_no_python_on_the_main_path(spark):
    plan = op4_license_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("text, ids", [
    ("Copyright 2020.\nLicensed under the Apache License, v. 2.0.", []), ("Copyright 2020\n2.0\nVersion 2.0", []),
    ("Subject to the GNU Public License, v. 2.0\nAll rights reserved.", ["RESERVED"]),
    (f"a. {licenses.SENTENCES['MPL_LINE']}. b", ["MPL_LINE"]),
])
def test_sentences_with_a_stop_inside_need_all_parts(make_docs, text, ids):
    assert [r.sentence_ids for r in licenses.recognise(make_docs([text])).collect()] == [ids]


APACHE_HEADER = """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
MIT_TEXT = """The MIT License (MIT)

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
GPL_HEADER = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
BSD2_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD3_TEXT = BSD2_TEXT + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this file"""


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// ", "; ", "-- "])
def test_published_notices_are_wrapped(make_docs, mark):
    notices = [APACHE_HEADER, MIT_TEXT, GPL_HEADER, BSD2_TEXT, BSD3_TEXT, MPL_HEADER, MPL_HEADER.replace("v. 2.0", "v.\n2.0")]
    texts = ["first line\n" + "\n".join(mark + x for x in t.split("\n")) + "\nlast line" for t in notices]
    got = {r.doc_id: r.licenses for r in licenses.recognise(make_docs(texts + [t.replace("\n", "\r\n") for t in texts])).collect()}
    want = [["Apache-2.0"], ["MIT"], ["GPL-3.0-or-later"], ["BSD-2-Clause"], ["BSD-3-Clause", "BSD-2-Clause"], ["MPL-2.0"], ["MPL-2.0"]]
    assert [got[i] for i in range(len(got))] == want + want
