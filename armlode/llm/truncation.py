"""Texts stored without their end: field limits by length spikes, broken transfers by how texts end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlode.operators.scale import bounded_broadcast

#: A length is a spike when at least SPIKE_LEAST texts have it and SPIKE_TIMES as many as the lengths around it.
SPIKE_LEAST, SPIKE_TIMES, SPIKE_AROUND = 4, 8.0, 200
#: A field limited in bytes ends before a character that would not fit.
BYTES_SHORT = 3
#: Characters at the end of a text that are searched for its last line that is no comment; where they hold none whole, the text is.
#: How a text ends is read from that line whole, or from so many characters where it is shorter.
TAIL, END = 1024, 300

# How texts end.
_TRAILER = r"(?:[\s\p{Z}\p{C}]|(?<=[\n\r])[ \t]*+%[^\n\r]*+(?=[\n\r]|$))++$"
_CLOSE = r"\\end\{document\}$"
_READS = r"\\(?:input|include|subfile|InputIfFileExists)\{[^{}\n]*\}$|\\endinput$"
_COMMAND = r"\\(?:end|label|bibliography|bibliographystyle|printbibliography|pagebreak|vspace|thispagestyle)\*?(?:\[[^\]\n]*\])?\{[^{}\n]*\}$|\\(?:fi|\]|par|qed|maketitle|appendix|tableofcontents|newpage|clearpage|printbibliography|balance)$|\$\$$"
_SENTENCE = r"[.!?…][)\]}\"'”’»“]*$"
_ABBREVIATION = r"(?:\b(?:e\.g|i\.e|cf|z\.\s?B|d\.\s?h|Figs?|Eqs?|Secs?|Refs?|Tab|Abb|Ann|Soc|vs|resp|bzw|vgl|vol|Vol|pp|Nr|No)|(?<![\p{L}\p{N}$}])\p{Lu})\.$"
_KEYWORDS = r"(?i)^\s*(?:\\(?:textbf|emph|paragraph|noindent|keywords)\s*\{?\s*)*(?:key\s?words|index terms|mots[- ]cl[ée]s|palabras[- ]clave|schlagw[öo]rter|schl[üu]sselw[öo]rter|stichw[öo]rter|msc|pacs)\b[^\n]*$"
_SIGNATURE = r"^\s*(?:--|---|—|–)\s*\p{L}[^\n]{0,80}$"
_MARK = r"\s*\[\s*(?:truncated|cut|shortened|gekürzt|tronqué|truncado|…|\.\.\.)\s*\]$"
_DOTS = r"(?:…|\.\.\.|\\l?dots(?:\{\})?)$"
#: Before the article's closing line: a sentence, a command with its braces, a formula or table row.
_BEFORE_CLOSE = r"(?:[.!?:…][)\]}\"'”’»“]*|[}\])$]|\\\\|\\(?:fi|par|qed|maketitle|appendix|tableofcontents|newpage|clearpage|printbibliography))$"
_ENVIRONMENT = r"(?<!\\)%[^\n\r]*|\\(?:begin|end)\{[^{}\n]*\}"


def length_spikes(documents: DataFrame) -> DataFrame:
    """(source, measure, length): the lengths in characters or bytes that far more texts of a source have than those around.

    Histograms are counted per source over all texts; the counts, not the texts, are then compared along
    the lengths, so a source with a third of all texts is no larger than its number of lengths.
    """
    rows = documents.select(F.coalesce("source", F.lit("")).alias("source"), F.explode(F.array(F.struct(F.lit("chars").alias("measure"), F.length("text").alias("length")), F.struct(F.lit("bytes").alias("measure"), F.octet_length("text").alias("length")))).alias("m"))
    counts = rows.groupBy("source", "m.measure", "m.length").agg(F.count("*").alias("n")).filter("length > 0")
    around = Window.partitionBy("source", "measure").orderBy("length").rangeBetween(-SPIKE_AROUND, SPIKE_AROUND)
    level = (F.sum("n").over(around) - F.col("n")) / (2 * SPIKE_AROUND)
    return counts.withColumn("level", level).filter((F.col("n") >= SPIKE_LEAST) & (F.col("n") >= SPIKE_TIMES * (F.col("level") + 0.1))).select("source", "measure", "length", "n")


def open_environments(text: Column) -> Column:
    """Environments that are begun and not ended, comments apart, in order; an end closes what was begun within."""
    marks = F.filter(F.regexp_extract_all(text, F.lit(_ENVIRONMENT), F.lit(0)), lambda m: m.startswith("\\"))

    def step(open_: Column, mark: Column) -> Column:
        name = F.regexp_extract(mark, r"\{([^{}\n]*)\}", 1)
        last = F.array_position(F.reverse(open_), name).cast("int")
        return F.when(mark.startswith("\\begin"), F.array_append(open_, name)).when(last > 0, F.slice(open_, F.lit(1), F.size(open_) - last)).otherwise(open_)

    return F.aggregate(marks, F.array().cast("array<string>"), step)


def endings(documents: DataFrame) -> DataFrame:
    """Adds what a text's end shows: ``ending`` without trailing space and comments, and the flags read from it."""
    def ends(text: Column) -> Column:
        """Without what trails; without the article's closing line and what trails before it, too."""
        core = F.regexp_replace(text, _TRAILER, "")
        return F.when(core.rlike(_CLOSE), F.struct(F.lit(True).alias("closed"), F.regexp_replace(F.regexp_replace(core, _CLOSE, ""), _TRAILER, "").alias("rest"))).otherwise(F.struct(F.lit(False).alias("closed"), core.alias("rest")))

    d = documents.withColumn("_end", ends(F.right(F.col("text"), F.lit(TAIL))))
    # without a line break it may be the rest of a line whose start, perhaps a comment's, lies further ahead
    partial = ~F.col("_end.rest").contains("\n") & (F.length("text") > TAIL)
    d = d.withColumn("_end", F.when(partial, ends(F.col("text"))).otherwise(F.col("_end")))
    d = d.withColumns({"closed": F.col("_end.closed"), "_line": F.substring_index("_end.rest", "\n", -1)})
    # the whole last line, however long; a short one with what stands before it
    d = d.withColumn("ending", F.when(F.length("_line") > END, F.col("_line")).otherwise(F.right(F.col("_end.rest"), F.lit(END)))).drop("_end")
    end = F.col("ending")
    line = F.col("_line")
    # an odd number of dollars in the last line: a formula that is not closed
    dollars = F.length(F.regexp_replace(F.regexp_replace(line, r"\\.", ""), r"[^$]", ""))
    formula = dollars % 2 == 1
    sentence = end.rlike(_SENTENCE) & ~end.rlike(_ABBREVIATION)
    return d.withColumns({
        "marked": end.rlike(_MARK),
        "dotted": end.rlike(_DOTS),
        "reads": end.rlike(_READS),
        "sentence": sentence & ~formula,
        "command": end.rlike(_COMMAND),
        "listing": line.rlike(_KEYWORDS) | line.rlike(_SIGNATURE),
        "before_close": end.rlike(_BEFORE_CLOSE) & ~end.rlike(_ABBREVIATION) & ~formula,
    }).drop("_line")


def judge(documents: DataFrame) -> DataFrame:
    """Every text with ``cut`` and ``reason``: (doc_id, source, n, cut, reason, at_limit).

    * mark: the store's own mark stands at the end;
    * limit: the length is a spike of the source, in characters or bytes, and the text does not end as one ends: no
      terminal punctuation, or dots that the store may have added;
    * closing: the article's closing line follows something unfinished;
    * article: an article was begun and not closed, and nothing else is read in;
    * environment: a piece without an article ends within an environment;
    * broken: the text ends within a word, command, formula or sentence.

    Null, empty and blank texts (of space, separators and control characters) are never cut. Ties, repeated rows and null ids are judged row by row; extra columns
    are ignored; an empty table gives no rows.
    """
    d = documents.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "text")
    spikes = bounded_broadcast(length_spikes(d).select("source", "measure", "length"))
    some = F.col("text").isNotNull() & F.col("text").rlike(r"[^\s\p{Z}\p{C}]")
    limits = spikes.groupBy("source").agg(
        F.collect_set(F.when(F.col("measure") == "chars", F.col("length"))).alias("chars_at"), F.collect_set(F.when(F.col("measure") == "bytes", F.col("length"))).alias("bytes_at")
    )
    size = F.octet_length("text")
    near = F.exists("bytes_at", lambda b: (size <= b) & (size >= b - BYTES_SHORT))
    e = endings(d.filter(some)).join(bounded_broadcast(limits), "source", "left").withColumn("at_limit", F.coalesce(F.array_contains("chars_at", F.length("text")) | near, F.lit(False)))
    article = F.col("text").contains("\\begin{document}")
    left_open = F.size(open_environments(F.col("text"))) > 0
    unfinished = ~F.col("sentence") & ~F.col("command") & ~F.col("listing") & ~F.col("dotted")
    reason = (
        F.when(F.col("marked"), "mark")
        .when(F.col("closed"), F.when(~F.col("before_close") | (F.col("dotted") & F.col("at_limit")), "closing"))
        .when(F.col("reads"), None)
        .when(article, F.when(F.col("at_limit"), "limit").otherwise("article"))
        .when(F.col("at_limit") & (unfinished | F.col("dotted")), "limit")
        .when(left_open, "environment")
        .when(unfinished, "broken")
    )
    return e.select("doc_id", "source", reason.isNotNull().alias("cut"), reason.alias("reason"), "at_limit")


def cut_texts(documents: DataFrame) -> DataFrame:
    """(doc_id): the documents whose stored text lacks its end."""
    # exploded, not filtered: a filter on the verdict would be pushed below and evaluate the texts' ends over and over
    return judge(documents).select(F.explode(F.when(F.col("cut") & F.col("doc_id").isNotNull(), F.array("doc_id")).otherwise(F.array().cast("array<bigint>"))).alias("doc_id")).distinct()


def cut_shares(documents: DataFrame) -> DataFrame:
    """Per source: texts that are not blank, those that are cut, and their share."""
    return judge(documents).groupBy("source").agg(F.count("*").alias("texts"), F.count_if("cut").alias("cut_texts"), F.round(F.avg(F.col("cut").cast("double")), 6).alias("cut_share"))
