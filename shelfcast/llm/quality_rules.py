"""Quality rules: base limits on text statistics, and robust multivariate outliers per language and source.

DataFrame and SQL expressions only. The statistics of a text become a vector of five transformed numbers, kept as
whole thousandths, so that all sums are exact and every run agrees. For each language and source the minimum
covariance determinant is sought by concentration steps from two starts: take the three quarters of the texts nearest
to the medians, by all numbers or by the two of length alone, estimate means and covariances, take the nearest three
quarters by Mahalanobis distance, and again, until no group's determinant changes. The start with the smaller
determinant counts. A text beyond the cutoff distance under its estimate is rejected.

Values and distances are rounded to a bounded grid, so exact quantiles keep a bounded number of counts per
group, and a group is one row after map-side combining: a source with a third of all rows is no burden. That row goes
back to the texts as a broadcast while the groups are counted to be few, else by a salted join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import written

MIN_WORDS, MAX_REPEATED_PERCENT = 20, 30
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"

#: Share of a group that the estimates rest on, and most concentration steps; they end when nothing changes any more.
CORE, STEPS = 0.75, 10
#: The covariance of the nearest three quarters of five normal variables is smaller than that of all by this factor:
#: CORE over the share of a chi-square with seven degrees below the CORE quantile of one with five.
CONSISTENCY = 1.4121
#: Mahalanobis distance squared beyond which a text is rejected: the 99.9 percent quantile of chi-square, five degrees.
CUTOFF = 20.515
#: Texts by which a group's covariance is drawn to the prior one.
PRIOR_TEXTS = 20

#: Transformed statistics in thousandths: expression over the base statistics, prior deviation, least deviation. Most
#: groups have no symbols and no repeats at all, where any would be infinitely far without a least deviation; with it,
#: an axis alone rejects at 4.53 of them: a symbol for each 30 characters, a repeated line for each 20 words, a quarter
#: of all words repeated, words a quarter longer or shorter than usual, or a length 4 times or a quarter the usual one
#: in a group of equal lengths.
VECTOR: dict[str, tuple[str, float, float]] = {
    "v1": ("ln(1.0e0 + n_words)", 1.2, 0.3),
    "v2": ("ln((1.0e0 + word_chars) / (1.0e0 + n_words))", 0.3, 0.05),
    "v3": ("sqrt(n_symbols / (1.0e0 + word_chars))", 0.15, 0.04),
    "v4": ("sqrt(n_dup_lines / (1.0e0 + n_words))", 0.15, 0.05),
    "v5": ("sqrt(n_repeat_words / (1.0e0 + n_words))", 0.15, 0.11),
}
AXES = list(VECTOR)
#: The axes by which each start ranks the texts of a group.
STARTS = (AXES, AXES[:2])
#: Groups whose row is broadcast (a row has some 50 numbers), and the salts of a group's row beyond that.
BROADCAST_GROUPS, SALTS = 10_000, 32
PAIRS = [(a, b) for k, a in enumerate(AXES) for b in AXES[: k + 1]]


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words in runs of ``WINDOW`` words that occur twice or more in the text, first occurrences included."""

    def covered(pairs: Column) -> Column:
        last = F.size(pairs)

        def same(k: Column, other: Column) -> Column:
            return F.when((other >= 1) & (other <= last), F.get(pairs, other - 1)["h"] == F.get(pairs, k - 1)["h"])

        again = F.filter(
            F.transform(
                F.sequence(F.lit(1), last),
                lambda k: F.when(
                    F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)),
                    F.get(pairs, k - 1)["at"],
                ),
            ),
            lambda at: at.isNotNull(),
        )
        return bound(F.array_sort(again), steps)

    def steps(starts: Column) -> Column:
        gaps = F.transform(
            starts, lambda at, k: F.least(F.coalesce(F.get(starts, k + 1) - at, F.lit(WINDOW)), F.lit(WINDOW))
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        return F.transform(starts, lambda at: F.xxhash64(*(F.get(hashes, at + k) for k in range(WINDOW))))

    def counted(found: Column) -> Column:
        pairs = F.array_sort(F.transform(found, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(bound(pairs, covered))

    hashes = F.transform(words, lambda word: F.xxhash64(word))
    found = bound(bound(hashes, windows), counted)
    return F.when(F.size(words) <= WINDOW, 0).otherwise(found)


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and ``lang, source``, stored once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        bound(
            words,
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                repeated_words(w).cast("long").alias("n_repeat_words"),
            ),
        ).alias("of_words"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        bound(
            F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            lambda lines: F.size(lines) - F.size(F.array_distinct(lines)),
        )
        .cast("long")
        .alias("n_dup_lines"),
    )
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    of_words = [F.col(f"of_words.{c}") for c in ("n_words", "word_chars", "n_repeat_words")]
    flat = rows.select("doc_id", "lang", "source", "n_symbols", "n_dup_lines", *of_words)
    group = F.to_json(F.struct("lang", "source")).alias("grp")
    vector = [F.expr(f"cast(round(1000 * {VECTOR[c][0]}) as bigint)").alias(c) for c in AXES]
    return written(flat.select("doc_id", group, *names, *vector), "quality-statistics")


def estimate_columns(k: int) -> dict[str, str]:
    """Means and covariances of start ``k`` from exact sums, scaled, drawn to the prior and kept from vanishing."""
    out = {f"m{k}_{a}": f"cast(s{k}_{a} as double) / n{k}" for a in AXES}
    for a, b in PAIRS:
        spread = f"(cast(s{k}_{a}_{b} as double) - cast(s{k}_{a} as double) * cast(s{k}_{b} as double) / n{k})"
        own = f"{CONSISTENCY!r} * {spread} / (n{k} + {PRIOR_TEXTS})"
        if a == b:
            prior, least = ((1000 * d) ** 2 for d in VECTOR[a][1:])
            own += f" + {prior * PRIOR_TEXTS!r} / (n{k} + {PRIOR_TEXTS}) + {least!r}"
        out[f"c{k}_{a}_{b}"] = own
    return out


def factor_columns(k: int) -> list[dict[str, str]]:
    """The lower triangular root of the covariance matrix, one column of it after the other, and its ``det``."""
    levels = []
    for j, b in enumerate(AXES):
        before = AXES[:j]
        root = f"c{k}_{b}_{b}" + "".join(f" - l{k}_{b}_{x} * l{k}_{b}_{x}" for x in before)
        levels.append({f"l{k}_{b}_{b}": f"sqrt({root})"})
        below = {}
        for a in AXES[j + 1 :]:
            rest = f"c{k}_{a}_{b}" + "".join(f" - l{k}_{a}_{x} * l{k}_{b}_{x}" for x in before)
            below[f"l{k}_{a}_{b}"] = f"({rest}) / l{k}_{b}_{b}"
        if below:
            levels.append(below)
    levels.append({f"det{k}": "round(" + " + ".join(f"ln(l{k}_{a}_{a})" for a in AXES) + ", 6)"})
    return levels


def solve_columns(k: int | str) -> list[dict[str, str]]:
    """Forward substitution: the squared Mahalanobis distance is the sum of the squares of ``z_*``."""
    levels = []
    for j, a in enumerate(AXES):
        rest = f"{a} - m{k}_{a}" + "".join(f" - l{k}_{a}_{b} * z{k}_{b}" for b in AXES[:j])
        levels.append({f"z{k}_{a}": f"({rest}) / l{k}_{a}_{a}"})
    levels.append({f"d2{k}": " + ".join(f"z{k}_{a} * z{k}_{a}" for a in AXES)})
    levels.append({f"d{k}": f"cast(round(100 * ln(1.0e0 + d2{k})) as bigint)"})
    return levels


def sums(k: int) -> dict[str, str]:
    """Exact sums over the core of start ``k``: the number of texts, the values and their products."""
    inside = f"d{k} <= core{k}"
    out = {f"n{k}": f"count(case when {inside} then 1 end)"}
    out |= {f"s{k}_{a}": f"sum(case when {inside} then {a} end)" for a in AXES}
    products = {f"s{k}_{a}_{b}": f"{a} * {b}" for a, b in PAIRS}
    return out | {c: f"sum(case when {inside} then cast({e} as decimal(38,0)) end)" for c, e in products.items()}


def with_columns(df: DataFrame, levels: list[dict[str, str]]) -> DataFrame:
    for level in levels:
        df = df.withColumns({c: F.expr(e) for c, e in level.items()})
    return df


def start_distance(k: int) -> str:
    return "cast(round(1000 * ln(1.0e0 + " + " + ".join(
        f"(({a} - q_{a}) / {1000 * VECTOR[a][1]!r}) * (({a} - q_{a}) / {1000 * VECTOR[a][1]!r})" for a in STARTS[k]
    ) + ")) as bigint)"


def with_group(rows: DataFrame, groups: DataFrame, number: int) -> DataFrame:
    """Rows beside their group's row, of which there are ``number``."""
    if number <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(groups), "grp")
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("doc_id", *AXES), F.lit(SALTS)).cast("int")
    return rows.withColumn("salt", salt).join(salted, ["grp", "salt"]).drop("salt")


def chosen_columns() -> dict[str, str]:
    """The estimate with the smaller determinant; of equal ones, that of the first start."""
    names = [f"m{{}}_{a}" for a in AXES] + [f"l{{}}_{a}_{b}" for a, b in PAIRS]
    return {n.format(""): f"case when det1 < det0 then {n.format(1)} else {n.format(0)} end" for n in names}


def outlier_distances(rows: DataFrame) -> DataFrame:
    """The rows with ``d2``, the squared robust Mahalanobis distance within their group."""
    starts = range(len(STARTS))
    medians = rows.groupBy("grp").agg(
        *(F.expr(f"percentile_disc(0.5) within group (order by {a})").alias(f"q_{a}") for a in AXES)
    )
    medians = written(medians, "quality-medians")
    number = medians.count()
    near = {f"d{k}": F.expr(start_distance(k)) for k in starts}
    at = with_group(rows, medians, number).withColumns(near).select(*rows.columns, *near)
    before = None
    for _ in range(STEPS + 1):
        limits = at.groupBy("grp").agg(
            *(F.expr(f"percentile_disc({CORE}) within group (order by d{k})").alias(f"core{k}") for k in starts)
        )
        core = with_group(at, written(limits, "quality-limits"), number)
        estimates = core.groupBy("grp").agg(*(F.expr(e).alias(c) for k in starts for c, e in sums(k).items()))
        for k in starts:
            estimates = with_columns(estimates, [estimate_columns(k), *factor_columns(k)])
        kept = [f"m{k}_{a}" for k in starts for a in AXES] + [f"l{k}_{a}_{b}" for k in starts for a, b in PAIRS]
        estimates = written(estimates.select("grp", *kept, *(f"det{k}" for k in starts)), "quality-estimates")
        if before is not None and estimates.exceptAll(before).isEmpty():
            break
        before = estimates
        at = with_group(rows, estimates, number)
        for k in starts:
            at = with_columns(at, solve_columns(k))
        at = at.select(*rows.columns, *near)
    chosen = estimates.select("grp", *(F.expr(e).alias(c) for c, e in chosen_columns().items()))
    return with_columns(with_group(rows, chosen, number), solve_columns("")).select(*rows.columns, "d2")


BASE_FAILED = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words"


def verdicts(docs: DataFrame) -> DataFrame:
    """Base statistics of every row, ``base_failed``, ``kept`` and the robust distance ``d2``.

    Null and empty texts have zero statistics and fail the base rule; null languages and sources form groups of
    their own; repeated rows and null ids are kept as rows; an empty table gives no rows. Texts at equal distances are
    in the core or out of it together; a text of any length is one row of numbers after its scan. In a small group the
    prior covariance prevails, so a lone text is never an outlier of itself. Other columns are not read.
    """
    found = outlier_distances(statistics(docs))
    failed = F.expr(BASE_FAILED)
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("d2") <= CUTOFF)).alias("kept"),
        "d2",
    )
