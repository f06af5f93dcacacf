"""Document quality by weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0) on a document. Expectation-maximisation
over the vote patterns, of which there are at most 3^rules whatever the corpus, estimates
how often each rule is right and how many documents are good; the posterior of a
document's pattern then replaces all-must-pass filtering. The whole estimate is one fold
over an array in one row, so nothing of the corpus is collected.

Results in odd cases: a null, empty or blank text has zero words and counts, fails the base
rules, and its rules abstain but for the length; repeated rows get a row each; an empty
table gives an empty result; other columns are not read. Texts of any length are handled as
arrays of their words, in n log n steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the base rules: the white space that separates words, and the symbols.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"

ROUNDS = 25


def text_counts(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and more counts.

    A word repeats if it is in a window of three words found twice or more in its text.
    Windows are compared by 64-bit hash and their places are found by sorting, so the
    cost stays n log n for a text that repeats itself all through.
    """
    text = F.coalesce("text", F.lit(""))
    words = documents.select("doc_id", text.alias("text")).withColumn(
        "words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    )
    windows = F.when(
        F.size("words") > 2,
        F.expr(
            "array_sort(transform(sequence(0, size(words) - 3), i -> "
            "struct(xxhash64(words[i], words[i + 1], words[i + 2]) AS h, i AS i)))"
        ),
    )
    lined = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    counted = words.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit(r"[!?]")).cast("long").alias("n_shouts"),
        F.regexp_count("text", F.lit(",")).cast("long").alias("n_commas"),
        F.regexp_count("text", F.lit("[0-9]")).cast("long").alias("n_digits"),
        lined.alias("lines"),
        windows.alias("windows"),
    )
    repeated = F.expr(
        "array_sort(transform(filter(windows, (w, k) -> w.h <=> get(windows, k - 1).h OR "
        "w.h <=> get(windows, k + 1).h), w -> w.i))"
    )
    placed = counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_upper",
        "n_shouts",
        "n_commas",
        "n_digits",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.alias("places"),
    )
    # A place adds as many words as lie before the next one, three at most.
    covered = F.expr(
        "aggregate(places, struct(0L AS n, -3 AS last), (s, p) -> "
        "struct(s.n + least(3, p - s.last) AS n, p AS last), s -> s.n)"
    )
    return placed.select("*", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).drop("places")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


RULES = ("length", "word_size", "symbols", "shouting", "capitals", "repeats", "lines", "commas", "digits")


def quality_votes() -> dict[str, Column]:
    """The rules over the columns of ``text_counts``; between their bounds they abstain.

    The rules of ``GUESSED`` are habits of prose that sound text often breaks; what their
    votes are worth is left to the estimate.
    """
    n = F.greatest("n_words", F.lit(1))
    mean = F.col("word_chars") / n
    return {
        "length": _vote(F.col("n_words") < 20, F.col("n_words") >= 50),
        "word_size": _vote((mean < 2) | (mean > 15), mean.between(3, 10)),
        "symbols": _vote(F.col("n_symbols") > 0.15 * n, F.col("n_symbols") <= 0.03 * n),
        "shouting": _vote(F.col("n_shouts") > 0.2 * n, F.col("n_shouts") <= 0.05 * n),
        "capitals": _vote(
            F.col("n_upper") > 0.5 * F.col("word_chars"), F.col("n_upper") <= 0.15 * F.col("word_chars")
        ),
        "repeats": _vote(F.col("n_repeat_words") > 0.3 * n, F.col("n_repeat_words") <= 0.1 * n),
        "lines": _vote(
            F.col("n_dup_lines") > 0.5 * F.col("n_lines"), F.col("n_dup_lines") <= 0.1 * F.col("n_lines")
        ),
        "commas": _vote(
            (F.col("n_commas") < 0.035 * n) | (F.col("n_commas") > 0.085 * n),
            (F.col("n_commas") >= 0.04 * n) & (F.col("n_commas") <= 0.08 * n),
        ),
        "digits": _vote(F.col("n_digits") > 0.1 * n, F.col("n_digits") <= 0.02 * n),
    }


# Bounds of the estimates. The bad bounds of most rules lie beyond what sound text shows, so
# such a rule is taken to vote bad on two in a thousand good documents at most: these rules
# of known strength tell the two classes apart. The rules of GUESSED are only taken to be
# right more often than not on good documents. Bad documents mostly break one rule of many,
# so few bad votes are expected.
GUESSED = ("commas", "digits")
KNOWN_RIGHT = (0.998, 0.9999)
GUESSED_RIGHT = (0.5, 0.9999)
GUESSED_START = 0.9
BAD_RIGHT = (0.02, 0.95)
BAD_START = 0.3
SHARE_GOOD = (0.02, 0.98)


def right_bounds(names: list[str], known: tuple[float, float] = KNOWN_RIGHT) -> list[tuple[float, float, float]]:
    """Least, greatest and first estimate of how often each rule is right on good documents."""
    return [(*GUESSED_RIGHT, GUESSED_START) if name in GUESSED else (*known, known[0]) for name in names]


def pattern_posteriors(
    votes: DataFrame, names: list[str], rounds: int = ROUNDS, known: tuple[float, float] = KNOWN_RIGHT
) -> DataFrame:
    """Posterior of good for each vote pattern, and the estimates it rests on.

    One row per pattern, so at most 3^rules rows: counted with partial sums, then gathered
    into one row and folded there. A rule has two accuracies, the share of its votes that is
    right on good documents and on bad ones; abstaining says nothing.
    """
    patterns = votes.groupBy(F.array(*names).alias("v")).agg(F.count("*").alias("n"))
    gathered = patterns.agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("p"))
    each = f"sequence(0, {len(names) - 1})"
    posterior = f"""1 / (1 + exp(ln(1 - s.share) - ln(s.share) - aggregate({each}, 0D, (t, j) -> t + CASE q.v[j]
        WHEN 1 THEN ln(s.good[j]) - ln(1 - s.bad[j]) WHEN -1 THEN ln(1 - s.good[j]) - ln(s.bad[j]) ELSE 0D END)))"""

    def doubles(values: list[float]) -> str:
        return f"array({', '.join(f'{v}D' for v in values)})"

    def bounded(value: str, least: str, most: str) -> str:
        return f"least({most}, greatest({least}, {value}))"

    def between(value: str, bounds: tuple[float, float]) -> str:
        return bounded(value, f"{bounds[0]}D", f"{bounds[1]}D")

    low, high, start = (doubles(list(column)) for column in zip(*right_bounds(names, known)))

    def right(weight: str, vote: int) -> str:
        """Share of a rule's votes that is ``vote``, over documents of weight ``weight``."""
        cast = f"aggregate(e, {{}}D, (t, q) -> t + q.n * {weight} * CASE WHEN q.v[j] {{}} THEN 1D ELSE 0D END)"
        return f"{cast.format(1, f'= {vote}')} / {cast.format(2, '<> 0')}"

    step = f"""
      aggregate(sequence(1, {rounds}),
        named_struct('share', 0.9D, 'good', {start}, 'bad', array_repeat({BAD_START}D, {len(names)})),
        (s, r) -> aggregate(array(transform(p, q -> named_struct('v', q.v, 'n', q.n, 'g', {posterior}))), s,
          (old, e) -> named_struct(
            'share', {between("aggregate(e, 0D, (t, q) -> t + q.n * q.g) / nullif(aggregate(e, 0D, (t, q) -> t + q.n), 0D)", SHARE_GOOD)},
            'good', transform({each}, j -> {bounded(right("q.g", 1), f"{low}[j]", f"{high}[j]")}),
            'bad', transform({each}, j -> {between(right("(1 - q.g)", -1), BAD_RIGHT)}))))
    """
    fitted = gathered.select("p", F.expr(step).alias("s"))
    scored = F.expr(f"transform(p, q -> named_struct('v', q.v, 'n', q.n, 'posterior', {posterior}))")
    return fitted.select(F.explode(scored).alias("q"), "s").select(
        F.col("q.v").alias("votes"),
        F.col("q.n").alias("n_documents"),
        F.col("q.posterior").alias("posterior"),
        F.col("s.share").alias("share_good"),
        F.col("s.good").alias("right_on_good"),
        F.col("s.bad").alias("right_on_bad"),
    )


def judge_quality(documents: DataFrame, threshold: float = 0.5, rounds: int = ROUNDS) -> DataFrame:
    """Counts, base verdict, votes, posterior of good, and whether a document is kept."""
    from sunloom.session import materialise

    rules = quality_votes()
    counted = text_counts(documents)
    voted = counted.select("*", F.array(*rules.values()).alias("votes"))
    # Texts are analysed once; the votes are read back for the estimate and for the verdicts.
    voted = materialise(voted, "quality-votes")
    named = voted.select(*(F.col("votes")[k].alias(name) for k, name in enumerate(rules)))
    posteriors = pattern_posteriors(named, list(rules), rounds)
    # At most 3^rules patterns: bounded by the number of rules alone.
    judged = voted.join(F.broadcast(posteriors.select("votes", "posterior")), "votes", "left")
    return judged.select(
        *counted.columns,
        "votes",
        "posterior",
        base_failed().alias("base_failed"),
        (~base_failed() & (F.col("posterior") >= threshold)).alias("kept"),
    )
