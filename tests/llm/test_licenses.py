import pytest

from visitlens.llm import licenses


@pytest.fixture(scope="module")
def model(small):
    return licenses.train(small)


def hits(spark, model, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(h.paragraph, h.family) for h in r.hits if h.confirmed] for r in licenses.scan(rows, model, ["doc_id"]).collect()}
    return [got[i] for i in range(len(texts))]


def test_notices_in_the_corpus(small):
    """Every line of the corpus that names a licence, and no other."""
    import re
    named = {"Apache": "apache-2.0", "MIT": "mit", "CC BY-NC": "cc-by-nc-4.0", "GNU General": "gpl-3.0"}
    got = {r.doc_id: r for r in licenses.license_report(small).collect()}
    for r in small.collect():
        want = [next(v for k, v in named.items() if k in x) for x in r.text.split("\n") if re.search("(?i)licensed under|released under", x)]
        assert (got[r.doc_id].n_notices, got[r.doc_id].families) == (len(want), ",".join(sorted(set(want))))


def test_varied_notices(spark, model):
    texts = ["Intro line\nThis file is LICENSED under the Apache License, Version 2.0!\nend", "released under the MIT license",
             "SPDX-License-Identifier: MPL-2.0", "* Redistribution and use in source and binary forms, with or without modification, are permitted",
             "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "the license of my car was lost in the mit building",
             "under the bridge the version 2 of the story", "", None]
    got = hits(spark, model, texts)
    assert [[f for _, f in x] for x in got] == [["apache-2.0"], ["mit"], ["mpl-2.0"], ["bsd-3-clause"], ["cc-by-nc-4.0"], [], [], [], []]
    assert got[0][0][0] == 1


def test_edges_and_empty(edge_docs, no_docs):
    got = licenses.license_report(edge_docs)
    assert got.count() == edge_docs.count() and {r.n_notices for r in got.collect()} == {0}
    assert licenses.license_report(no_docs).count() == 0


def test_training_separates_classes():
    import numpy as np
    x = [np.array([1, 2]), np.array([2, 3]), np.array([7, 8]), np.array([8])]
    w, b = licenses._train(x, np.array([0, 0, 1, 1]), 2)
    assert all((w[f].mean(axis=0) + b).argmax() == y for f, y in zip(x, (0, 0, 1, 1)))


def test_reserved_rights_in_the_corpus(small):
    got = {r.doc_id: r for r in licenses.license_report(small).collect()}
    want = {r.doc_id: [i for i, x in enumerate(r.text.split("\n")) if x.strip() == "All rights reserved."] for r in small.collect()}
    assert sum(map(len, want.values())) == 3
    for doc, lines in want.items():
        assert (got[doc].n_reserved, got[doc].first_reserved) == (len(lines), min(lines, default=None))


GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
BSD = """# Redistribution and use in source and binary forms, with or
# without modification, are permitted provided that the
# following conditions are met:"""


def test_wrapped_notices(spark, model):
    texts = [GPL, f"An intro line\n{BSD}\n# more\n\nan end", "Released under the\nMIT License.", f"words before\n\n{GPL}\n\nand\n\n{BSD}",
             "All rights\nreserved.", "Redistribution and use in source and binary forms, with or\n\nwithout modification, are permitted provided that the",
             "Released under the MIT License.\nReleased under the\nMIT License.", "This work is licensed under the\nriver by the terms of\nthe general story"]
    assert hits(spark, model, texts) == [[(0, "gpl-3.0")], [(1, "bsd-3-clause")], [(0, "mit")], [(2, "gpl-3.0"), (9, "bsd-3-clause")],
                                         [(0, "all-rights-reserved")], [], [(0, "mit")], []]


def test_wrapped_notices_do_not_depend_on_passes(spark, model, monkeypatch):
    monkeypatch.setattr(licenses, "PASS_WORDS", 3)
    assert hits(spark, model, [GPL, "x\n" + BSD]) == [[(0, "gpl-3.0")], [(1, "bsd-3-clause")]]


def test_kin_of_the_families_are_not_confirmed(spark, model):
    texts = ["This work is licensed under the GNU General Public License, version 2", GPL.replace("version 3", "version 2"),
             "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
             "This work is licensed under a Creative Commons Attribution 3.0 International License", "Licensed under CC BY-SA 4.0",
             "Licensed under the Apache License, Version 1.1", "Distributed under the BSD 2-Clause License",
             "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1"]
    assert hits(spark, model, texts) == [[]] * len(texts)
    kept = [t for family in licenses.TEMPLATES.values() for t in family]
    assert [[f for _, f in x] for x in hits(spark, model, kept)] == [[k] for k, family in licenses.TEMPLATES.items() for _ in family]
