"""The numpy pass of op8 reads the same canonical words as the column expressions, and finds the same windows."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from txnspark.llm import decontaminate, template_windows

ODD = [
    None, "", " ", "One two.", " Leading Space", "end. Next Sentence Here", "a  Double Space", "line\nBreak Name", "5 kg of 3  kg 7\tkg 9 - kg 2 KG 4 kg.",
    "$5.00 %  10% 1,000.5 ..5 5.. a.)5 3/4 12:30 v1.2 ½ ٣ 4th", "don't (stop) \"quoted\" --- ... ,;: x-ray", "Éa École élan ÉCOLE Σας ΣΑΣ İstanbul ǅungla",
    "数据 Ab 数Ab café's naïve space tab\tName", "x" * 3000 + " Y" + "y" * 3000, "a\x01b \x01Cd e\x01", "I Am Not A", "the Name.The Name? Yes !Name", "日本 km 5 km", "A1 Bb2 c3",
]


def test_canonical_words_agree(spark):
    rng = random.Random(1)
    parts = [w for t in ODD if t for w in t.split()] + list("aB5$%.,:/!?-") + ["kg", "Hour", "\n", "  ", "é", "É"]
    texts = ODD + ["".join(rng.choice([" ", " ", "\n", ". ", ""]) + rng.choice(parts) for _ in range(60)) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    want = [r["t"] for r in df.select("i", decontaminate.template(F.col("text"))["t"].alias("t")).orderBy("i").collect()]
    reader = template_windows.Reader(decontaminate.UNITS)
    hashes, counts = [], []
    for _, raw, cuts in template_windows.slices(pa.array(texts)):
        h, c = reader.words(raw, cuts)
        hashes.append(h)
        counts.append(c)
    hashes, counts = np.concatenate(hashes).tolist(), np.concatenate(counts).tolist()
    assert counts == [len(t) for t in want]
    words = [w for t in want for w in t]
    one, other = {}, {}
    for h, w in zip(hashes, words, strict=True):
        assert one.setdefault(w, h) == h and other.setdefault(h, w) == w


def test_windows_stay_in_their_text():
    words = np.arange(10, dtype=np.uint64)
    text, place, h = template_windows.windows(words, np.array([4, 0, 2, 4]), 3)
    assert text.tolist() == [0, 0, 3, 3] and place.tolist() == [0, 1, 0, 1] and len(set(h.tolist())) == 4
    assert len(template_windows.windows(words[:2], np.array([1, 1]), 2)[0]) == 0
