"""Secrets in texts: fixed patterns, and tokens that pass a battery of randomness tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.plans.shared import materialise

# The patterns of the contract. A run of 32 or more hexadecimal digits is
# a leftmost match of [0-9a-f]+ that is long enough, and likewise for access keys.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Natural language: chance that two letters agree, that three agree, and that the
#: next character is of another class (lower case, upper case, digit, sign).
COINCIDENCE, TRIPLE, CHANGE = 0.066, 0.0056, 0.08
#: Alphabets from the smallest, each with its size. A token counts as drawn from the first
#: that covers it; drawn evenly from a larger one, it would be even over that one too.
ALPHABETS = [
    ("hex", "[0-9a-f]+|[0-9A-F]+", 16), ("base26", "[a-z]+|[A-Z]+", 26), ("base32", "[a-z2-7]+|[A-Z2-7]+", 32), ("base36", "[a-z0-9]+|[A-Z0-9]+", 36),
    ("base52", "[A-Za-z]+", 52), ("base62", "[A-Za-z0-9]+", 62), ("base64", ".+", 64),
]
#: A token is not random if the battery's p-value is below this: the share of random ones lost.
LOST = 0.003


def _tail(z: str) -> str:
    """A bound from above, within two per cent, of the chance that a normal variable exceeds ``z``; 1 below 0."""
    # Sampford's inequality
    return f"IF({z} <= 0, 1D, 4 * exp(-least(700, {z} * {z} / 2)) / sqrt(2 * pi()) / (3 * {z} + sqrt({z} * {z} + 8)))"


#: Kinds of spans in the order of the contract, each with its pattern, the group whose length counts, and that length.
KINDS = [("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 1), ("hex", HEX, 0, 1), ("random", TOKEN, 0, 1)]


def _matches(text: Column, kind: int) -> Column:
    """Of each match of a kind: characters before it since the last one, its length, that of its group, and a token's text."""
    _, pattern, group, _ = KINDS[kind]
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), 0).alias("m"),
        F.regexp_extract_all(text, F.lit(pattern), group).alias("g"),
    )
    token = (lambda x: x["m"]) if kind == 3 else (lambda x: F.lit(None).cast("string"))
    entry = lambda x: F.struct(F.lit(kind).alias("kind"), F.length(x["gap"]).alias("gap"), F.length(x["m"]).alias("len"), F.length(x["g"]).alias("group"), token(x).alias("token"))
    # what follows the last match is a gap without one
    listed = F.transform(F.filter(found, lambda x: x["m"].isNotNull()), entry)
    return F.when(text.rlike(pattern), listed).otherwise(F.array().cast("array<struct<kind:int,gap:int,len:int,group:int,token:string>>"))


def _spans(scanned: DataFrame) -> DataFrame:
    """``row, kind, start, stop, token`` of all matches that are long enough, and of tokens outside those of other kinds.

    Places are running sums, and overlaps are seen from running maxima of a text's
    spans in order, so that a text costs as many steps as it has matches.
    """
    each = scanned.select("row", F.posexplode("matches").alias("at", "x")).select("row", "at", "x.*")
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("stop", F.sum(F.col("gap") + F.col("len")).over(so_far).cast("int")).withColumn("start", F.col("stop") - F.col("len"))
    least = F.element_at(F.array(*[F.lit(n) for *_, n in KINDS]), F.col("kind") + 1)
    placed = placed.where(F.col("group") >= least).withColumn("base", F.col("kind") < 3)
    forth, back = Window.partitionBy("row").orderBy("start", F.desc("base")), Window.partitionBy("row").orderBy(F.desc("start"), "base")
    before = F.max(F.when(F.col("base"), F.col("stop"))).over(forth.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumn("before", before).withColumn("after", after)
    free = (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.coalesce("after", F.col("stop")) >= F.col("stop"))
    return placed.where(F.col("base") | free).select("row", "kind", "start", "stop", "token")


def _battery(tokens: DataFrame) -> DataFrame:
    """Adds ``p_random`` (of a token drawn evenly, by the battery) and ``z`` (how unlike text the token is)."""
    code = "ascii(c)"
    value = {  # place of a character in the encoding's alphabet
        "hex": f"CASE WHEN c BETWEEN '0' AND '9' THEN {code} - 48 ELSE {code} % 32 + 9 END",
        "base26": f"{code} % 32 - 1",
        "base32": f"CASE WHEN c BETWEEN '2' AND '7' THEN {code} - 24 ELSE {code} % 32 - 1 END",
        "base36": f"CASE WHEN c BETWEEN '0' AND '9' THEN {code} - 48 ELSE {code} % 32 + 9 END",
        "base64": f"CASE WHEN c BETWEEN 'A' AND 'Z' THEN {code} - 65 WHEN c BETWEEN 'a' AND 'z' THEN {code} - 71 WHEN c BETWEEN '0' AND '9' THEN {code} + 4 WHEN c IN ('+', '-') THEN 62 ELSE 63 END",
    }
    value |= {"base52": value["base64"], "base62": value["base64"]}
    t = tokens.withColumn("body", F.expr("trim(TRAILING '=' FROM token)")).where("length(body) >= 16")
    encoding = "CASE " + " ".join(f"WHEN body RLIKE '^({chars})$' THEN '{e}'" for e, chars, _ in ALPHABETS) + " END"
    t = t.withColumn("encoding", F.expr(encoding)).withColumn("k", F.expr("CASE encoding " + " ".join(f"WHEN '{e}' THEN {k}" for e, _, k in ALPHABETS) + " END"))
    t = t.withColumn("c", F.explode(F.array(F.split("body", "", -1)))).withColumn("c", F.expr("filter(c, x -> x <> '')"))
    t = t.withColumn("n", F.size("c").cast("double"))
    values = "CASE encoding " + " ".join(f"WHEN '{e}' THEN transform(c, c -> {v})" for e, v in value.items()) + " END"
    t = t.withColumn("v", F.explode(F.array(F.expr(values))))
    t = t.withColumn("squares", F.expr("aggregate(array_distinct(c), 0D, (a, x) -> a + pow(n - length(replace(body, x, '')), 2))"))
    # chi-squared against the uniform alphabet; its exact mean is k - 1, its variance 2 (k - 1) (n - 1) / n
    t = t.withColumn("z_chi", F.expr("(k * squares / n - n - (k - 1)) / sqrt(2 * (k - 1) * (n - 1) / n)"))
    # runs of the upper and lower half of the alphabet
    t = t.withColumn("n1", F.expr("aggregate(v, 0D, (a, x) -> a + IF(2 * x >= k, 1, 0))")).withColumn("n2", F.expr("n - n1"))
    t = t.withColumn("runs", F.expr("aggregate(sequence(1, size(v) - 1), 1D, (a, i) -> a + IF((2 * v[i] >= k) <> (2 * v[i - 1] >= k), 1, 0))"))
    t = t.withColumn("z_runs", F.expr("(runs - 1 - 2 * n1 * n2 / n) / sqrt(nullif(2 * n1 * n2 * (2 * n1 * n2 - n) / (n * n * (n - 1)), 0))"))
    t = t.withColumn("mean", F.expr("aggregate(v, 0D, (a, x) -> a + x) / n"))
    t = t.withColumn("var", F.expr("aggregate(v, 0D, (a, x) -> a + (x - mean) * (x - mean))"))
    t = t.withColumn("z_serial", F.expr("(aggregate(sequence(1, size(v) - 1), 0D, (a, i) -> a + (v[i] - mean) * (v[i - 1] - mean)) / nullif(var, 0) + 1 / n) * sqrt(n)"))
    # the battery's p-value, of the least likely of its three tests: too even a spread is no fault
    tests = [_tail("z_chi"), f"2 * {_tail('abs(z_runs)')}", f"2 * {_tail('abs(z_serial)')}"]
    t = t.withColumn("p_random", F.expr(f"coalesce(least(1D, 3 * least({', '.join(tests)})), 0D)"))
    # under the hypothesis of text: coincidences as in language, and few changes of character class
    expected = f"(n + n * (n - 1) * {COINCIDENCE})"
    spread = f"sqrt(4 * n * (n - 1) * (n - 2) * ({TRIPLE} - {COINCIDENCE ** 2}) + 2 * n * (n - 1) * {COINCIDENCE})"
    t = t.withColumn("z_text", F.expr(f"({expected} - squares) / {spread}"))
    kinds = "translate(translate(translate(body, 'abcdefghijklmnopqrstuvwxyz', repeat('a', 26)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', repeat('A', 26)), '0123456789', repeat('0', 10))"
    t = t.withColumn("changes", F.expr(f"length(regexp_replace({kinds}, '(.)\\\\1*', 'x')) - 1"))
    t = t.withColumn("z_change", F.expr(f"(changes - (n - 1) * {CHANGE}) / sqrt((n - 1) * {CHANGE * (1 - CHANGE)})"))
    return t.withColumn("z", F.expr("(z_text + z_change) / sqrt(2)")).select(*tokens.columns, "encoding", "p_random", "z")


def _discoveries(scored: DataFrame, rate: float) -> DataFrame:
    """Benjamini-Hochberg within each doubling of length, from a histogram of p-values.

    A token's p-value is the chance that text is as unlike text as it is, and 1 if the
    battery finds it not random. The histogram has at most 24 lengths x 1200 steps of z
    however many tokens there are; a step counts with the chance of its lower edge and
    chances are bounded from above, so neither adds discoveries.
    """
    binned = scored.withColumn("long", F.expr("least(23, cast(floor(log2(stop - start)) AS int))")).withColumn(
        "step", F.expr(f"IF(p_random < {LOST}, -200, cast(floor(greatest(-20, least(100, z)) * 10) AS int))")
    )
    steps = binned.groupBy("long", "step").agg(F.count("*").alias("n"))
    limits = steps.selectExpr(
        "long", "step", f"{_tail('(step / 10D)')} AS p", "sum(n) OVER (PARTITION BY long ORDER BY step DESC) AS found", "sum(n) OVER (PARTITION BY long) AS m"
    ).where(F.expr(f"p <= {rate} * found / m"))
    limits = limits.groupBy("long").agg(F.min("step").alias("limit"))
    return binned.join(F.broadcast(limits), "long").where("step >= limit").drop("long", "step", "limit")


def secrets(docs: DataFrame, rate: float = 0.01) -> DataFrame:
    """Spans of secrets in every text.

    Returns one row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex,
    base_sha256, spans``. Places count code points, ends are exclusive, and a span
    is a whole match. Base kinds are ``assign``, ``access`` and ``hex``; ``random``
    spans are tokens of 20 or more characters outside base spans. Each is tested
    against even draws from the smallest alphabet that covers it (``ALPHABETS``): a
    chi-squared test, a runs test and one of serial correlation give the battery's
    p-value, and tokens below ``LOST`` are no secrets. How unlike text the others are
    is held against the false-discovery ``rate`` among all tokens of about their
    length in all documents. Letters of one case only are too like text to be
    discovered. Null and empty texts have no spans, repeated rows get equal
    results, and an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    scanned = docs.select("doc_id", text.alias("t")).select(
        "doc_id", F.monotonically_increasing_id().alias("row"), F.concat(*[_matches(F.col("t"), kind) for kind in range(4)]).alias("matches")
    )
    scanned = materialise(scanned, "scanned")
    spans = materialise(_spans(scanned.where("size(matches) > 0")), "spans")
    scored = materialise(_battery(spans.where("kind = 3").drop("kind")), "scored")
    added = _discoveries(scored, rate).select("row", F.lit(3).alias("kind"), "start", "stop")
    found = spans.where("kind < 3").drop("token").unionByName(added)
    found = found.groupBy("row").agg(
        *[F.count_if(F.col("kind") == kind).alias(f"n_{KINDS[kind][0]}") for kind in range(3)],
        F.array_sort(F.collect_list(F.struct("start", "kind", "stop"))).alias("s"),
    )
    names = ", ".join(f"'{name}'" for name, *_ in KINDS)
    shown = lambda which: f"array_join(transform({which}, s -> concat_ws(':', element_at(array({names}), s.kind + 1), s.start, s.stop)), ',')"
    found = found.select("row", *[f"n_{name}" for name, *_ in KINDS[:3]], F.expr(shown("filter(s, s -> s.kind < 3)")).alias("base"), F.expr(shown("s")).alias("spans"))
    none = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return scanned.select("doc_id", "row").join(found, "row", "left").select(
        "doc_id",
        *[none(f"n_{name}") for name, *_ in KINDS[:3]],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
