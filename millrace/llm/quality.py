"""Line-first cleaning.

Every line is judged by punctuation, navigation and boilerplate rules, lines that fail are removed, and a document that
loses too much of its text that way is rejected. A line that is long, doesn't end a sentence and goes on in the next line
with a lower-case letter, or one of a script without case, is wrapped: it is judged together with the next. Columns only:
no row leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import GAP, GAP_CHARS, let, words

SYMBOLS = r"[#*$%&|<>]"
#: Marks that end a sentence, of scripts that have them (Unicode property Sentence_Terminal, and the Tibetan shad).
ENDS = ".!?…‼⁇⁈⁉。！？．｡।॥۔؟։՜՞።፧፨။།༎៕᠃᠉᙮꓿"
CLOSERS = "[\"'”’»)\\]]"
#: Wordings of notices that sites put on every page.
NOTICES = (
    "all rights reserved|licen[sc]ed under|released under the|this work is licensed|terms of (use|service)|privacy policy"
    "|uses? cookies|cookie policy|enable javascript|lorem ipsum|subscribe to our|sign up for|click here|skip to content"
)


@dataclass(frozen=True)
class LineRules:
    """A line fails when it doesn't end a sentence and is short (under ``fragment_words``) or has none inside, when runs of symbols stand on more than ``noise`` of its words, when
    it has doubled exclamation marks on more than ``shouting`` of them, when ``separators`` of its words are menu
    separators, or when it has a notice and at most ``notice_words`` words. A document is rejected when the lines that
    fail hold more than ``most_lost`` of its characters. A line of ``wrapped_chars`` characters or more may go on in the
    next one; the two then count as one line."""

    fragment_words: int = 8
    noise: float = 0.1
    shouting: float = 0.2
    separators: float = 0.15
    notice_words: int = 25
    most_lost: float = 0.5
    wrapped_chars: int = 40


def true_break(rules: LineRules) -> str:
    """A line feed after a short line or the end of a sentence, or before anything that doesn't go on with it."""
    return rf"\n(?:(?<![^\n]{{{rules.wrapped_chars}}}\n)|(?<=[{ENDS}]{CLOSERS}{{0,3}}[ \t\r]{{0,2}}\n)|(?![\p{{Ll}}\p{{Lo}}]))"


def _repeat_words(all_words: Column) -> Column:
    """Words that stand in a 3-word window found at least twice."""

    def places(hashes: Column) -> Column:
        def covered(sorted_: Column) -> Column:
            pairs = F.zip_with(sorted_, F.slice(sorted_, F.lit(2), F.size(sorted_)), lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)))
            starts = F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))
            return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

        entries = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(entries, covered))

    def windows(w: Column) -> Column:
        n = F.size(w)
        pairs = F.zip_with(w, F.slice(w, F.lit(2), n), lambda a, b: F.xxhash64(a, b))
        triples = F.zip_with(pairs, F.slice(w, F.lit(3), n), lambda a, b: F.xxhash64(a, b))
        return F.when(n < 3, F.lit(0)).otherwise(let(F.slice(triples, F.lit(1), n - 2), places))

    return windows(all_words)


def line_fails(line: Column, rules: LineRules) -> Column:
    n = F.greatest(F.size(F.split(F.btrim(line, F.lit(GAP_CHARS)), GAP)), F.lit(1))
    end = F.right(F.btrim(line, F.lit(GAP_CHARS)), F.lit(4))
    unended = ~end.rlike(f"[{ENDS}]{CLOSERS}*$")
    noisy = F.regexp_count(line, F.lit(r"[#*$%&<>]{2,}")) > n * rules.noise
    shouted = F.regexp_count(line, F.lit("!!")) > n * rules.shouting
    menu = F.regexp_count(line, F.lit(r"(?<!\S)[|»›•·](?!\S)")) >= n * rules.separators
    notice = (n <= rules.notice_words) & F.lower(line).rlike(NOTICES)
    fragment = (n < rules.fragment_words) | ~line.rlike(rf"[{ENDS}]{CLOSERS}*\s")
    return (unended & fragment) | noisy | shouted | menu | notice


def line_quality(docs: DataFrame, rules: LineRules = LineRules(), *, id: str = "doc_id", text: str = "text", clean: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id, figures of the whole text, ``base_failed``, ``kept``; in input order, no shuffle.

    ``clean`` names a column with the text that is left; ``kept_chars`` counts its characters without line ends
    (but those inside wrapped lines, which stay); ``n_lines_removed`` counts wrapped lines as one. A null
    text has no words, so it fails; so do an empty one and one of white space. Repeated rows are judged alike, a null id
    is passed on, other columns are not read (so their names don't matter), an empty table gives an empty result.
    """
    return _judged(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("_given")), rules, clean)


def _judged(docs: DataFrame, rules: LineRules, clean: str | None, passed: tuple[str, ...] = ()) -> DataFrame:
    def with_word(line: Column) -> Column:
        return line.rlike(r"[^\x20\x09-\x0D]")

    whole = F.coalesce(F.col("_given"), F.lit(""))
    lined = docs.select("doc_id", whole.alias("_text"), *passed)
    judged = lined.select(
        "doc_id",
        "_text",
        *passed,
        let(words(F.col("_text")), lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r"))).alias("_w"),
        let(
            F.filter(F.split("_text", "\n"), with_word),
            lambda lines: F.size(lines) - F.size(F.array_distinct(lines)),
        ).alias("_dup"),
        let(
            F.filter(F.split("_text", true_break(rules)), with_word),
            lambda lines: F.struct(
                F.aggregate(lines, F.lit(0).cast("bigint"), lambda s, x: s + F.char_length(x)).alias("chars"),
                F.filter(lines, lambda x: ~line_fails(x, rules)).alias("left"),
                F.size(lines).alias("n"),
            ),
        ).alias("_l"),
    )
    n, repeat = F.col("_w.n").cast("bigint"), F.col("_w.r").cast("bigint")
    left = F.aggregate("_l.left", F.lit(0).cast("bigint"), lambda s, x: s + F.char_length(x))
    base_failed = (n < 50) | (100 * repeat > 50 * n)
    # through a generator, so that a filter on the verdict isn't pushed below and all of this computed again for it
    judged = judged.select("doc_id", *passed, F.inline(F.array(F.struct("_text", "_w", "_dup", "_l"))))
    out = judged.select(
        "doc_id",
        *passed,
        n.alias("n_words"),
        (F.char_length("_text") - F.regexp_count("_text", F.lit(r"[\x20\x09-\x0D]"))).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.col("_dup").cast("bigint").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"),
        base_failed.alias("base_failed"),
        F.col("_l.chars").alias("_chars"),
        left.alias("kept_chars"),
        (F.col("_l.n") - F.size("_l.left")).cast("bigint").alias("n_lines_removed"),
        *([F.array_join("_l.left", "\n").alias(clean)] if clean else []),
    )
    kept = ~F.col("base_failed") & (F.col("kept_chars") >= F.col("_chars") * (1 - rules.most_lost))
    return out.withColumn("kept", kept).drop("_chars")


def cleaned(docs: DataFrame, rules: LineRules = LineRules(), *, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns, and the text that is left."""
    whole = docs.select(F.lit(None).alias("doc_id"), F.col(text).alias("_given"), F.struct(*docs.columns).alias("_row"))
    kept = _judged(whole, rules, "_clean", ("_row",)).where("kept")
    return kept.select(*[F.col("_clean").alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns])
