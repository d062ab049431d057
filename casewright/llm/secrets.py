"""Secret scans: fixed patterns, and a likelihood ratio of two character Markov models."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from casewright.llm.common import written

# Fixed patterns, in the order in which kinds are listed. A run of hexadecimal digits, or
# of letters and digits behind the prefix, either reaches its length or holds no match, so
# the length stands in the pattern; a too short assignment still uses up its characters.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
#: Candidates of the Markov models.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
_LEAST_ASSIGNED = 12
_CODES = 128


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratios (random over ordinary, thousandths) of pairs of characters, by
    code, and the least mean ratio per pair that makes a token random."""

    ratios: tuple[int, ...]
    least: int


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    """Matches in order: structs of the length before, the match and a group of it."""
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("before"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    found = F.transform(F.filter(parts, lambda p: p["match"].isNotNull()), lambda p: F.struct(
        F.length(p["before"]).alias("before"), F.length(p["match"]).alias("size"), p["value"].alias("value")))
    empty = F.array().cast("array<struct<before:int,size:int,value:string>>")
    return F.when(text.rlike(pattern), found).otherwise(empty)


def _pairs(token: Column) -> Column:
    """Codes of neighbouring characters as one number each; all are ASCII."""
    codes = F.transform(F.split(token, ""), lambda c: F.ascii(c))
    codes = F.filter(codes, lambda c: c > 0)
    return F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1),
                      lambda a, b: a * _CODES + b)


def ratio(token: Column, model: Model) -> Column:
    """Mean log-likelihood ratio of a token's pairs, in thousandths."""
    table = F.split(F.lit(",".join(map(str, model.ratios))), ",").cast("array<int>")  # folded to a constant
    sums = F.aggregate(_pairs(token), F.lit(0).cast("long"), lambda s, p: s + F.element_at(table, p + 1))
    return sums / F.greatest(F.length(token) - 1, F.lit(1))


def fit(docs: DataFrame, text_col: str = "text", rows: int = 20_000, least: int = 1000, prior: float = 20.0,
        rounds: int = 6) -> Model:
    """Train both models on a bounded sample of labelled strings.

    The sample are about ``rows`` documents, by a hash of their text. What the fixed
    patterns match there is labelled random, other tokens of 16 or more characters are
    labelled ordinary; each distinct string counts once. Counts of neighbouring characters
    (at most 128 x 128 of either label) are smoothed with ``prior`` observations: of the
    even alphabet for random strings, of single characters for ordinary ones. A missing
    label leaves an even model. The least ratio of a random token is ``least`` thousandths a
    pair, whatever the sample holds. The ordinary strings may include the random ones that
    are sought: their model is fitted again to the half that looked least random, then, for
    ``rounds`` at most, to all that stay below the least ratio. Strings sought may be up to
    half of the distinct ones.
    """
    n = docs.count()
    text = F.col(text_col)
    sample = docs.where(F.pmod(F.xxhash64(text), F.lit(1 << 30)) < math.ceil((1 << 30) * min(1.0, rows / max(1, n))))
    text = F.coalesce(text, F.lit(""))
    values = sample.select(
        F.transform(_found(text, ASSIGN, 2), lambda m: m["value"]).alias("assigned"),
        F.concat(*[F.transform(_found(text, p), lambda m: m["value"]) for p in (ACCESS, HEX)]).alias("fixed"),
        F.transform(_found(F.regexp_replace(text, f"{ASSIGN}|{ACCESS}|{HEX}", " "), TOKEN), lambda m: m["value"]).alias("other"),
    )
    assigned = F.filter("assigned", lambda v: F.length(v) >= _LEAST_ASSIGNED)
    strings = written(values.select(F.explode(F.array(
        F.struct(F.lit(1).alias("label"), F.concat(assigned, "fixed").alias("v")),
        F.struct(F.lit(0).alias("label"), F.col("other").alias("v")),
    )).alias("s")).select("s.label", F.explode("s.v").alias("v")).distinct(), "secret-strings")
    alphabet = [ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]

    def trained(strings: DataFrame) -> Model:
        counts = strings.select("label", F.explode(_pairs(F.col("v"))).alias("p")).groupBy("label", "p").count().collect()
        seen = {(r["label"], r["p"]): r["count"] for r in counts}
        from_a = {(k, a): sum(seen.get((k, a * _CODES + b), 0) for b in alphabet) for k in (0, 1) for a in alphabet}
        to_b = {b: 1 + sum(seen.get((0, a * _CODES + b), 0) for a in alphabet) for b in alphabet}
        single = {b: n / sum(to_b.values()) for b, n in to_b.items()}

        ratios = [0] * (_CODES * _CODES)
        for a in alphabet:
            for b in alphabet:
                pair = a * _CODES + b
                random = (seen.get((1, pair), 0) + prior / len(alphabet)) / (from_a[1, a] + prior)
                ordinary = (seen.get((0, pair), 0) + prior * single[b]) / (from_a[0, a] + prior)
                ratios[pair] = round(1000 * math.log(random / ordinary))
        return Model(tuple(ratios), least)

    model = trained(strings)
    most = strings.where("label = 0").agg(F.percentile(ratio(F.col("v"), model), F.lit(0.5))).first()[0]
    for _ in range(rounds if most is not None else 0):
        last, model = model, trained(strings.where((F.col("label") == 1) | (ratio(F.col("v"), model) <= most)))
        if model == last:
            break
        most = least - 1
    return model


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans``.

    ``spans`` lists ``kind:start:end`` by start, then kind (assign, access, hex, random), in
    code points, end exclusive; ``base_sha256`` digests those of the fixed patterns. Random
    spans are tokens whose mean likelihood ratio reaches the model's least and that overlap
    no fixed one. Matches leave the scan as lengths; running sums over the matches of a text
    turn them into offsets, in linear time. Null texts count as empty; identifiers may be
    null or repeated; an empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def kind(number: int, found: Column, ok) -> Column:
        return F.transform(found, lambda m, i: F.struct(
            F.lit(number).alias("kind"), i.alias("i"), m["before"].alias("before"), m["size"].alias("size"),
            ok(m).alias("ok")))

    always = lambda m: F.lit(True)
    tokens = kind(3, _found(text, TOKEN), lambda m: ratio(m["value"], model) >= model.least)
    rows = written(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        F.concat(
            kind(0, _found(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= _LEAST_ASSIGNED),
            kind(1, _found(text, ACCESS), always), kind(2, _found(text, HEX), always),
        ).alias("base"),
        tokens.alias("tokens"),
    ).select(
        # Tokens matter only where one of them is random.
        "row", "doc_id", F.when(F.exists("tokens", lambda t: t["ok"]), F.concat("base", "tokens")).otherwise(F.col("base")).alias("found"),
    ), "secret-matches")
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.select("row", F.explode("found").alias("m")).select("row", "m.*").repartition("row")
        .withColumn("end", F.sum(F.col("before") + F.col("size")).over(upto))
        .withColumn("start", F.col("end") - F.col("size")).where("ok")
    )
    fixed = F.col("kind") < 3
    order = Window.partitionBy("row").orderBy("start", "kind")
    left = F.max(F.when(fixed, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    right = F.min(F.when(fixed, F.col("start"))).over(order.rowsBetween(0, Window.unboundedFollowing))
    kept = placed.withColumns({"left": left, "right": right}).where(
        fixed | ((F.coalesce("left", F.lit(0)) <= F.col("start")) & (F.coalesce("right", F.col("end")) >= F.col("end"))))
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    said = F.concat_ws(":", name, "start", "end")
    per = kept.groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{n}") for k, n in enumerate(KINDS)],
        F.array_sort(F.collect_list(F.struct("start", "kind", said.alias("said")))).alias("all"),
    )
    joined = rows.select("row", "doc_id").join(per, "row", "left")
    spans = F.coalesce("all", F.array().cast("array<struct<start:bigint,kind:int,said:string>>"))

    def listed(s: Column) -> Column:
        return F.array_join(F.transform(s, lambda x: x["said"]), ",")

    return joined.select(
        "doc_id", *[F.coalesce(f"n_{n}", F.lit(0)).cast("long").alias(f"n_{n}") for n in KINDS],
        F.sha2(listed(F.filter(spans, lambda x: x["kind"] < 3)), 256).alias("base_sha256"), listed(spans).alias("spans"),
    )
