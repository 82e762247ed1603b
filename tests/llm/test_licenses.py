import math
import re

from parcelflow.llm.licenses import BLOCK, PHRASES, TEMPLATES, THRESHOLD, scan_licenses

from .cases import SCHEMA, documents

EXTRA = [
    "Released under the MIT License. MIT license, mit-license; mitlicense MIT LICENSES",
    "x " * 500 + "Licensed under the Apache License, Version 2.0." + " y" * 45 + " Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and its documentation files",
    "licensed under cc by sa " + "z " * 38 + "4 0",
    "general public\nlicense général public license",
]


def brute(rows):
    out = []
    for r in rows:
        low = re.sub(b"[A-Z]", lambda m: m[0].lower(), (r[1] or "").encode())
        w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places, base = [], set()
        for phrase, label in PHRASES.items():
            p = [x.encode() for x in phrase.split()]
            for i in range(len(w) - len(p) + 1):
                if w[i : i + len(p)] == p:
                    places.append(i)
                    base.add(label)
        best, labels = 1.0 if places else 0.0, set(base)
        for b in range(0, max(1, len(w)), BLOCK // 2):
            block = set(w[b : b + BLOCK])
            for label, t in TEMPLATES:
                own = {x.encode() for x in t.split()}
                if len(own & block) >= math.ceil(THRESHOLD * len(own) - 1e-9):
                    labels.add(label)
                    best = max(best, len(own & block) / len(own))
        out.append((r[0], len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), round(best, 9)))
    return sorted(map(repr, out))


def test_equals_brute_force(spark):
    rows = documents() + [(1000 + i, t, *[None] * 7) for i, t in enumerate(EXTRA * 2)]
    got = [(*tuple(r)[:-1], round(r["score"], 9)) for r in scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(map(repr, got)) == brute(rows)
    assert {"mit", "apache,cc-by-nc", "gpl"} <= {r[6] for r in got}


def test_empty(spark):
    assert scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def test_deciding_words(spark):
    """Notices that differ in one word, alone, spelled apart, and together in one block."""
    long = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    want = {
        long.format(""): "cc-by",
        long.format("-NonCommercial"): "cc-by-nc",
        long.format("-ShareAlike"): "cc-by-sa",
        long.format("-NonCommercial-ShareAlike"): "cc-by-nc-sa",
        long.format("-Non-Commercial"): "cc-by-nc",
        long.format(" Share Alike"): "cc-by-sa",
        long.format(" Non-Commercial Share Alike"): "cc-by-nc-sa",
        long.format("-NoDerivatives"): "",
        "Licensed under CC BY 4.0.": "cc-by",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Licensed under CC BY-SA 4.0.": "cc-by-sa",
        "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa",
        "Licensed under the GNU Lesser General Public License": "gpl,lgpl",
        "Licensed under the GNU Affero General Public License": "agpl,gpl",
        "Licensed under the GNU General Public License": "gpl",
        long.format("") + " " + long.format("-NonCommercial"): "cc-by,cc-by-nc",
        long.format("-ShareAlike") + " x" * 100 + " " + long.format("-NonCommercial-ShareAlike"): "cc-by-nc-sa,cc-by-sa",
        # the deciding word stands far from the notice, or in the next document
        long.format("-NoDerivatives") + " x" * 100 + " noncommercial": "",
    }
    rows = [(k, t) for k, t in enumerate(want)]
    got = {r["doc_id"]: r["labels"] for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert [(t, got[k]) for k, t in rows] == list(want.items())
