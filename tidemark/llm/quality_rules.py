"""Quality rules: fixed limits, then robust multivariate outliers within each language and source."""

from __future__ import annotations

from math import exp, factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.shared_files import stored

WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
RUN = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: The vector of a text: name, SQL over the counts, and the least standard deviation it is given. Sizes
#: enter by their logarithm and shares of characters by their square root, near which ordinary text is normal.
VECTOR = (
    ("v_length", "ln(n_words)", 0.5),
    ("v_word", "ln(word_chars / n_words)", 0.05),
    ("v_symbols", "sqrt(n_symbols / word_chars)", 0.04),
    ("v_upper", "sqrt(n_upper / word_chars)", 0.05),
    ("v_lines", "ln(n_words / n_lines)", 0.5),
    ("v_again", "n_dup_lines / n_lines / 2 + n_repeat_words / n_words", 0.1),
)
SIZE = len(VECTOR)
BINS = 32  # bins of a distance for each unit of its logarithm
WIDE = 3  # standard deviations of the prior of the whole table, in least ones
SHAPE_FILES = 8
SETTLED = 1e-6  # a step that lowers the logarithm of a determinant by less ends the search


def _chi_square(x: float, degrees: int) -> float:
    """Distribution function for an even number of degrees."""
    return 1 - exp(-x / 2) * sum((x / 2) ** j / factorial(j) for j in range(degrees // 2))


def chi_square_quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_square(middle, degrees) < share else (low, middle)
    return low


def _repeated(windows: Column) -> Column:
    """Words inside windows whose hash occurs again, each word counted once."""

    def covered(ordered: Column) -> Column:
        again = F.filter(
            ordered,
            lambda x, i: (F.get(ordered, i - 1).hash == x.hash) | (F.get(ordered, i + 1).hash == x.hash),
        )
        start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))
        fold = lambda a, at: F.struct(
            (a.words + at + RUN - F.greatest(at, a.end)).alias("words"), (at + RUN).alias("end")
        )
        return F.aggregate(F.sort_array(F.transform(again, lambda x: x.at)), start, fold).words

    ordered = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))
    # the array of one binds the sorted windows to a name, so that they are sorted once
    found = F.get(F.transform(F.array(ordered), covered), 0)
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(F.coalesce(found, F.lit(0)))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of every whole text (see `op7_quality_rules`), n_upper and n_lines (lines with a word)."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    cut = docs.withColumn("_words", F.regexp_extract_all(whole, F.lit(WORD), F.lit(0))).withColumn("_lines", lines)
    word = lambda i, k: F.get("_words", i + k)
    windows = F.when(
        F.size("_words") >= RUN,
        F.transform(F.sequence(F.lit(0), F.size("_words") - RUN), lambda i: F.xxhash64(*[word(i, k) for k in range(RUN)])),
    ).otherwise(F.array().cast("array<bigint>"))
    return (
        cut.withColumn("_windows", windows)
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.translate(whole, SPACE, "")).cast("long"))
        .withColumn("n_symbols", (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", _repeated(F.col("_windows")).cast("long"))
        .withColumn("n_upper", F.regexp_count(whole, F.lit(r"\p{Lu}")).cast("long"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .drop("_words", "_lines", "_windows")
    )


NAMES = [name for name, _, _ in VECTOR]
PAIRS = [(i, j) for i in range(SIZE) for j in range(i + 1)]
MEANS = [f"m{i}" for i in range(SIZE)]
FACTORS = [f"f{i}_{j}" for i, j in PAIRS]
COVARIANCE = [f"c{i}_{j}" for i, j in PAIRS]
SHAPE = ["n", "log_det", *MEANS, *COVARIANCE, *FACTORS]


def _distance() -> Column:
    """Squared Mahalanobis distance from the group's mean, with the inverse Cholesky factor of its covariance."""
    off = [F.col(NAMES[i]) - F.col(MEANS[i]) for i in range(SIZE)]
    rows = [sum((F.col(f"f{i}_{j}") * off[j] for j in range(i + 1)), F.lit(0.0)) for i in range(SIZE)]
    return sum((row * row for row in rows), F.lit(0.0))


def _start(vectors: DataFrame) -> DataFrame:
    """Mean and factor per group from each coordinate's median and quartiles, read off a histogram."""
    floors = F.lit([floor for _, _, floor in VECTOR])
    cells = vectors.select(
        "group", F.posexplode(F.array(*[F.round(F.col(n) * 200).cast("long") for n in NAMES])).alias("k", "cell")
    )
    counted = cells.groupBy("group", "k", "cell").agg(F.count("*").alias("n"))
    by = Window.partitionBy("group", "k")
    upto = F.sum("n").over(by.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("n").over(by)
    at = lambda share: F.min(F.when(F.col("upto") >= share, F.col("cell"))) / 200
    spread = (
        counted.withColumn("upto", upto)
        .groupBy("group", "k")
        .agg(at(0.5).alias("middle"), ((at(0.75) - at(0.25)) / 1.349).alias("scale"))
        .withColumn("scale", F.greatest("scale", F.get(floors, F.col("k"))))
    )
    pick = lambda k, value: F.max(F.when(F.col("k") == k, value))
    return spread.groupBy("group").agg(
        *[pick(k, F.col("middle")).alias(MEANS[k]) for k in range(SIZE)],
        *[(pick(i, 1 / F.col("scale")) if i == j else F.lit(0.0)).alias(f"f{i}_{j}") for i, j in PAIRS],
    )


def _starts(vectors: DataFrame) -> DataFrame:
    """Three first shapes a group (`start` 0 to 2): medians and quartiles without correlation, then around the medians the
    products of the standardised values' hyperbolic tangents, and of their directions. Far values weigh little in each."""
    first = _kept_small(_start(vectors))
    z = [(F.col(NAMES[i]) - F.col(MEANS[i])) * F.col(f"f{i}_{i}") for i in range(SIZE)]
    length = F.greatest(F.sqrt(sum((v * v for v in z), F.lit(0.0))), F.lit(1e-9))
    bent = {1: [F.tanh(v) for v in z], 2: [v / length for v in z]}
    sums = (
        vectors.join(first, "group")
        .groupBy("group", *MEANS, *[f"f{i}_{i}" for i in range(SIZE)])
        .agg(
            F.count("*").alias("n"),
            *[F.sum(v[i] * v[j]).alias(f"t{start}_{i}_{j}") for start, v in bent.items() for i, j in PAIRS],
        )
    )
    scaled = lambda start, i, j: F.col(f"t{start}_{i}_{j}") / F.col(f"f{i}_{i}") / F.col(f"f{j}_{j}")
    moments = [
        F.struct(
            F.lit(start).alias("start"),
            *[(F.col("n") * F.col(MEANS[i])).alias(f"s{i}") for i in range(SIZE)],
            *[(F.col("n") * F.col(MEANS[i]) * F.col(MEANS[j]) + scaled(start, i, j)).alias(f"p{i}_{j}") for i, j in PAIRS],
        )
        for start in bent
    ]
    both = sums.select("group", "n", F.explode(F.array(*moments)).alias("of")).select("group", "n", "of.*")
    bent_shapes = _factored(both, ["group", "start"]).select("group", "start", *MEANS, *FACTORS)
    return first.select("group", F.lit(0).alias("start"), *MEANS, *FACTORS).unionByName(bent_shapes)


def _concentrate(vectors: DataFrame, shape: DataFrame, share: float) -> DataFrame:
    """One concentration step: mean and factor of the `share` of each group that lies nearest under `shape`.

    Sums are taken by (group, start, bin of the distance) on the map side first, so that a group with most of the rows
    costs no task more than another; the nearest share is then a prefix of the bins.
    """
    key = ["group", "start"]
    products = [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"p{i}_{j}") for i, j in PAIRS]
    by_bin = (
        vectors.join(shape.select(*key, *MEANS, *FACTORS), "group")
        .withColumn("bin", F.floor(F.log1p(_distance()) * BINS))
        .groupBy(*key, "bin")
        .agg(F.count("*").alias("n"), *[F.sum(n).alias(f"s{i}") for i, n in enumerate(NAMES)], *products)
    )
    by = Window.partitionBy(*key)
    before = F.coalesce(F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = ["n", *[f"s{i}" for i in range(SIZE)], *[f"p{i}_{j}" for i, j in PAIRS]]
    near = (
        by_bin.withColumn("inside", before < share * F.sum("n").over(by))
        .where("inside")
        .groupBy(*key)
        .agg(*[F.sum(name).alias(name) for name in sums])
    )
    return _factored(near, key)


def _factored(sums: DataFrame, key: list[str], floored: bool = True) -> DataFrame:
    """Means, covariances, their determinant's logarithm and inverse Cholesky factors, from n, sums and sums of products.

    `floored`: the least variances are added to those found, so that no covariance is singular.
    """
    least = [floor**2 for _, _, floor in VECTOR]
    # one select whose columns refer to those before them, which is analysed once
    steps = [f"s{i} / n AS m{i}" for i in range(SIZE)]
    for i, j in PAIRS:
        steps.append(f"p{i}_{j} / n - m{i} * m{j}" + (f" + {least[i]!r}D" if floored and i == j else "") + f" AS c{i}_{j}")
    for i, j in PAIRS:
        rest = " - ".join([f"c{i}_{j}", *[f"l{i}_{k} * l{j}_{k}" for k in range(j)]])
        steps.append((f"sqrt(greatest({rest}, {least[i]!r}D))" if i == j else f"({rest}) / l{j}_{j}") + f" AS l{i}_{j}")
    for i, j in PAIRS:
        rest = " + ".join(f"l{i}_{k} * f{k}_{j}" for k in range(j, i))
        steps.append((f"1 / l{i}_{i}" if i == j else f"-({rest}) / l{i}_{i}") + f" AS f{i}_{j}")
    steps.append(" + ".join(f"2 * ln(l{i}_{i})" for i in range(SIZE)) + " AS log_det")
    return sums.selectExpr(*key, "n", *steps).select(*key, *SHAPE)


def _kept_small(shapes: DataFrame) -> DataFrame:
    """Shapes (one row per group and start), stored in a few files, so that their size stays that of their rows and Spark
    need not deal the vectors by group to meet them."""
    return stored(shapes.repartition(SHAPE_FILES), "shapes")


def _least(shapes: DataFrame) -> DataFrame:
    """Of each group's shapes the one of smallest determinant, of equal ones that of the smaller `start`."""
    whole = F.struct("start", *SHAPE)
    return shapes.groupBy("group").agg(F.min_by(whole, F.struct("log_det", "start")).alias("best")).select("group", "best.*")


def minimum_determinant(vectors: DataFrame, share: float, trial_steps: int = 2, most_steps: int = 30) -> DataFrame:
    """Per group the mean and covariance of the `share` of its rows whose covariance has the smallest determinant found.

    Every start takes `trial_steps` concentration steps; the one of smallest determinant goes on until no group's
    determinant falls any more. Steps only ever lower it (up to the width of a bin, so a step that raises it is not
    taken); `most_steps` is a guard.
    """
    shapes = _kept_small(_starts(vectors))
    for _ in range(trial_steps):
        shapes = _kept_small(_concentrate(vectors, shapes, share))
    best = _least(shapes)
    for _ in range(most_steps):
        best = _kept_small(best)
        after = _kept_small(_concentrate(vectors, best, share))
        before = best.select("group", F.col("log_det").alias("before"))
        if after.join(before, "group").where(F.col("log_det") < F.col("before") - SETTLED).isEmpty():
            break
        best = _least(best.unionByName(after.withColumn("start", F.lit(-1))))
    return best


def _shrunk(own: DataFrame, parents: DataFrame, prior_rows: float, correction: float) -> DataFrame:
    """Shapes of `own` (group, parent, rows and a shape) with `prior_rows` more rows that lie like their parent's.

    The moments of the two together: a group of many rows keeps its own shape, one of few has nearly its parent's, and
    nothing changes at any size in between.
    """
    up = {name: f"up_{name}" for name in (*MEANS, *COVARIANCE)}
    above = parents.select(F.col("group").alias("parent"), *[F.col(name).alias(new) for name, new in up.items()])
    both = own.join(above, "parent")
    mean, over = lambda i: F.col(MEANS[i]), lambda i: F.col(up[MEANS[i]])
    product = lambda i, j: (
        F.col("rows") * (F.col(f"c{i}_{j}") * correction + mean(i) * mean(j))
        + prior_rows * (F.col(up[f"c{i}_{j}"]) + over(i) * over(j))
    )
    moments = both.select(
        "group",
        (F.col("rows") + prior_rows).alias("n"),
        *[(F.col("rows") * mean(i) + prior_rows * over(i)).alias(f"s{i}") for i in range(SIZE)],
        *[product(i, j).alias(f"p{i}_{j}") for i, j in PAIRS],
    )
    return _factored(moments, ["group"], floored=False)


def group_shapes(vectors: DataFrame, share: float, prior_rows: float) -> DataFrame:
    """Mean, covariance and factor of every group at its three levels: source in language, language, all.

    `vectors` holds `levels` (the names of the three groups a row is in, inmost first) and the vector. Each group's
    minimum covariance determinant, corrected for the share, is shrunk toward its language's by `prior_rows`, that one
    toward the whole table's, and that toward a wide fixed one around its own mean.
    """
    each = vectors.select(F.explode("levels").alias("group"), *NAMES)
    level = F.col("levels")
    pairs = [(level[0], level[1]), (level[1], level[2]), (level[2], F.lit("top"))]
    steps = F.array(*[F.struct(inner.alias("group"), outer.alias("parent")) for inner, outer in pairs])
    above = vectors.select(F.posexplode(steps)).select("pos", "col.group", "col.parent")
    tree = above.groupBy("pos", "group", "parent").agg(F.count("*").alias("rows"))
    placed = stored(tree.join(minimum_determinant(each, share), "group"), "shapes")
    correction = share / _chi_square(chi_square_quantile(share, SIZE), SIZE + 2)
    wide = lambda i, j: F.lit((WIDE * VECTOR[i][2]) ** 2 if i == j else 0.0)
    top = placed.where("pos = 2").select(F.lit("top").alias("group"), *MEANS, *[wide(i, j).alias(f"c{i}_{j}") for i, j in PAIRS])
    found = top
    for level in (2, 1, 0):
        found = stored(_shrunk(placed.where(F.col("pos") == level), found, prior_rows, correction), "shapes")
    return found


def judge(docs: DataFrame, carry: list[str], share: float = 0.75, prior_rows: float = 50, tail: float = 1e-6) -> DataFrame:
    """The columns `carry` of every row, its counts, base_failed, distance and kept.

    base_failed: fewer than 10 words, or more than a fifth of the words in 5-word runs that occur again.
    All other texts become vectors (`VECTOR`), grouped by language and source. Each group's minimum covariance
    determinant over `share` of its rows is sought from several starts (`minimum_determinant`) and shrunk toward its
    language's and the whole table's as if it had `prior_rows` more rows like those (`group_shapes`): every text gets a
    verdict, by one rule at every size. A text is rejected if its squared Mahalanobis distance is beyond the chi-square
    quantile 1 - `tail`.

    Null texts are empty and fail. Null languages and sources are values like others. Repeated rows count as
    often as they occur. An empty table gives none. Columns of `docs` named like a result column are replaced; no other
    name clashes.
    """
    made = [*COUNTS, "n_upper", "n_lines", "base_failed", "distance", "kept"]
    carry = [name for name in carry if name not in made]
    json = lambda *parts: F.to_json(F.struct(*parts))
    lang, source = F.col("lang").alias("l"), F.col("source").alias("s")
    own, wider = F.concat(F.lit("s"), json(lang, source)), F.concat(F.lit("l"), json(lang))
    packed = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in carry]).alias("carried"), "text", F.array(own, wider, F.lit("all")).alias("levels")
    )
    counted = with_counts(packed).select("carried", "levels", *COUNTS, "n_upper", "n_lines")
    table = stored(counted, "counts").withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    )
    vector = [F.expr(formula).alias(name) for name, formula, _ in VECTOR]
    shapes = group_shapes(table.where("NOT base_failed").select("levels", *vector), share, prior_rows)
    limit = chi_square_quantile(1 - tail, SIZE)
    vectored = table.select("*", *[F.when(~F.col("base_failed"), F.expr(formula)).alias(name) for name, formula, _ in VECTOR])
    return (
        vectored.withColumn("group", F.col("levels")[0])
        .join(shapes.select("group", *MEANS, *FACTORS), "group", "left")
        .withColumn("distance", _distance())
        .withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit))
        .select(*[F.col("carried").getField(name).alias(name) for name in carry], *COUNTS, "base_failed", "distance", "kept")
    )


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source")
    return judge(docs, ["doc_id"]).select("doc_id", *COUNTS, "base_failed", "kept", "distance")
