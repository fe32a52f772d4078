"""Hit passages are cut out of the texts by expressions, as a plain loop over the words would."""

import random

from pyspark.sql import functions as F

from aurum.llm import decontam


def _cut(text, spans):
    raw = text.encode().translate(decontam.FOLD)
    at, pos = [], 0
    while pos < len(raw):
        end = pos
        while end < len(raw) and raw[end] != 0x20:
            end += 1
        if end > pos:
            at.append((pos, end))
        pos = end + 1
    out, pos = b"", 0
    for i, j in spans:
        out += text.encode()[pos:at[i][0]]
        pos = at[j - 1][1]
    return (out + text.encode()[pos:]).decode()


def test_cut_as_a_plain_loop_without_python(spark):
    rng = random.Random(7)
    rows = [(0, None, []), (1, "", []), (2, "--", []), (3, "one", [(0, 1)]), (4, " a\t\U0001f600b é-C\n", [(0, 1), (2, 3), (3, 4)])]
    for k in range(5, 60):
        text = "".join(rng.choice(["ab", "É", "Z9", "漢", " ", ", ", "\n", "-", "\x7f", "\U0001f600", "[x]"]) for _ in range(rng.randint(1, 60)))
        n = len(decontam.words(text))
        cuts = sorted(rng.sample(range(n + 1), min(n + 1, 2 * rng.randint(0, 3))))
        rows.append((k, text, list(zip(cuts[::2], cuts[1::2]))))
    d = spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<start:int,end:int>>") \
        .withColumns({"n_words": F.lit(0), "items": F.array()})
    got = decontam.remove_hits(d)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {k: t if t is None else _cut(t, s) for k, t, s in rows}
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
