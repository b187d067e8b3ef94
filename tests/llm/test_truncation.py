import pytest
from pyspark.sql import functions as F

from armlode.llm import truncation

DOC = "doc_id long, source string, text string"
ARTICLE = "\\documentclass{a}\n\\begin{document}\nWe show it.\n"


def reasons(spark, texts, source="s"):
    d = spark.createDataFrame([(i, source, t) for i, t in enumerate(texts)], DOC)
    return {r["doc_id"]: r["reason"] for r in truncation.judge(d).collect()}


WHOLE = [
    "A sentence that ends.", "Does it end?", "See (Ann et al.).", "A cite~\\cite{a,b}.", "\\begin{abstract}\nWe show it.\n\\end{abstract}", "Text.\n\nKeywords: flux, drift, kernel", "Text.\n\nMots-clés: régime; schéma", "Text.\n\n-- the authors", "Text.\n\\label{sec:end}", "Text.\n% a comment that stops",
    ARTICLE + "\\end{document}", ARTICLE + "\\end{document}\n% end of file", ARTICLE + "\\begin{itemize}\n\\item Open.\n\\end{document}\n\n", ARTICLE + "\\input{tail/closing}\n", ARTICLE + "\\endinput", "We leave the rest to the reader …", "And so on, \\ldots", "More in a later version...", "$x$ is 3\\,\\%.", "\\[ a = b \\]", "Der Wert liegt bei 5.",
    "Uses a list in a comment.\n% \\begin{itemize}\nDone.",
]
CUT = [
    "A sentence that stops in a wo", "We treat the spectrum as,", "The value $x = ", "See Fig.", "As M. Smith and A.", "~\\cite{", "Text \\emph{On the", ARTICLE + "More text.", ARTICLE + "\\section{Main}\\label{sec:x}", "\\begin{abstract}\nWe show it.", "\\begin{tabular}{l}\n1 & 2 \\\\", ARTICLE + "We find that the\n\\end{document}\n",
    "The rest is gone [truncated]", ARTICLE + "It is lost…", "Ein übli�", "A $formula. ends within",
]


@pytest.mark.parametrize("text", WHOLE)
def test_whole_texts(spark, text):
    assert reasons(spark, [text]) == {0: None}


def test_cut_texts(spark):
    got = reasons(spark, CUT)
    assert [CUT[i] for i in got if got[i] is None] == [] and len(got) == len(CUT)


def test_a_last_line_of_any_length_is_read_whole(spark):
    long = ",".join(f"part{i}" for i in range(400))
    got = reasons(spark, [f"We end.\n\\bibliography{{{long}}}", f"We end.\nKeywords: {long}", f"We end.\n\\bibliography{{{long}", "word " * 900 + "end."])
    assert got == {0: None, 1: None, 2: "broken", 3: None}


def test_length_spikes_and_dots_at_the_limit(spark):
    import random

    rng = random.Random(5)
    word = lambda n: ("word " * (n // 5 + 1))[: n - 1]
    rows = [(i, "x", word(rng.randrange(300, 3000)) + ".") for i in range(300)]
    rows += [(1000 + i, "x", ("lorem ipsum " * 100)[:997] + "...") for i in range(20)]
    rows += [(2000 + i, "x", word(1000) + ".") for i in range(3)]  # whole texts as long as the field
    rows += [(3000, "y", "We stop here by ourselves...")]
    rows += [(4000 + i, "z", ("é" * 511) + "b"[: i % 2]) for i in range(12)]  # bytes: 1022 or 1023
    d = spark.createDataFrame(rows, DOC)
    spikes = {(r["source"], r["measure"], r["length"]) for r in truncation.length_spikes(d).collect()}
    assert ("x", "chars", 1000) in spikes
    out = {r["doc_id"]: r for r in truncation.judge(d).collect()}
    assert all(out[1000 + i]["reason"] == "limit" for i in range(20)) and not any(out[2000 + i]["cut"] for i in range(3)) and not out[3000]["cut"]
    assert sum(r["cut"] for i, r in out.items() if i < 1000) == 0
    share = {r["source"]: r["cut_share"] for r in truncation.cut_shares(d).collect()}
    assert abs(share["x"] - 20 / 323) < 1e-6 and share["y"] == 0.0


def test_blank_null_long_repeated_and_extra_columns(spark):
    long = ARTICLE + "word " * 60_000 + "end.\n" + "% tail\n" * 2000
    rows = [(1, "s", None), (2, "s", ""), (3, "s", " \n\t "), (4, "s", "\u00a0\u2003"), (5, "s", long), (6, "s", long + "\\end{document}"), (7, None, "cut of"), (7, None, "cut of"), (None, "s", "cut of")]
    d = spark.createDataFrame(rows, DOC)
    for c in ("ending", "closed", "reason", "chars_at", "length"):
        d = d.withColumn(c, F.lit(1))
    assert {r["doc_id"] for r in truncation.cut_texts(d).collect()} == {5, 7}
    assert truncation.cut_texts(d.limit(0)).count() == 0 and truncation.cut_shares(d.limit(0)).count() == 0


def test_open_environments(spark):
    t = "\\begin{a}\\begin{b}\\end{a}% \\begin{c}\n\\begin{d}\\end{x}\\begin{e}\\end{e}\\% \\begin{f}"
    d = spark.createDataFrame([(t,), ("",)], "text string").select(truncation.open_environments(F.col("text")).alias("o")).collect()
    assert [r["o"] for r in d] == [["d", "f"], []]
