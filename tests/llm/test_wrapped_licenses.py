"""License templates wrapped over line ends are found, whatever lines and windows they meet."""

import random

from tesserae.llm import license_scan as ls


def test_wrapped_templates_match_brute_force(spark):
    rng = random.Random(2)
    rows, want = [], []
    for i in range(140):
        template, label = ls.TEMPLATES[i % len(ls.TEMPLATES)]
        words = template.split()
        cut = rng.randint(1, len(words) - 1)
        before, after = (" ".join("filler" if rng.random() < 0.9 else "filler\n" for _ in range(rng.randint(0, 150))) for _ in range(2))
        rows.append((i, f"{before}\n{' '.join(words[:cut])},\n{' '.join(words[cut:])}.\n{after}"))
        w = ls.words_of(rows[-1][1])
        assert any(set(words) <= set(w[k : k + ls.BLOCK // 2]) for k in range(len(w)))
        want.append(label)
    rows.append((500, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted"))
    rows.append((501, "under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation"))
    got = {r.doc_id: set(r.labels.split(",")) for r in ls.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(label in got[i] for i, label in enumerate(want))
    assert got[500] == {"bsd"} and got[501] == {"lgpl"}
