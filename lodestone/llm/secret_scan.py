"""Secret scans judged by corpus-wide ownership, in DataFrame operations only.

Every text gives base spans of three kinds (assignments to password-like names, access key ids, long hex runs)
and bare candidates: long tokens that hold letters and digits and touch no base span. The hash of every value
is aggregated over the whole corpus by distinct repositories and owners (where there is no column of repositories,
documents stand for them). A value that `example_owners` owners or `example_repos` repositories or more share is a
widely copied example; any other is owner-specific and looks live. The method adds, as kind `owned`, the bare
candidates that look live and either mix upper case, lower case and digits or equal the value of some base span.
Base spans stay whatever the verdict.

Positions are code points, end exclusive. Matches come from regexp_extract_all and their places from running sums
over them and over the lengths of what split() leaves between them, which follow the same left-to-right search.
Matches become rows, so the work is linear in the text (but for sorting its matches), also for texts of very many.

Null and empty texts have no spans; null owners or repositories count as none; repeated rows are scanned each,
and count once in the distinct counts; spans that start together go by kind; an empty table gives an empty result.
Rows are told apart by a generated number, not by doc_id, so ids may repeat or be null. A value that very many rows
share is pre-aggregated before the shuffle, and its join is one that Spark can split. redact() keeps all columns,
whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, split_join

KINDS = ("assign", "access", "hex", "owned")
NAMES = "password|passwd|secret|token|api_?key"
ASSIGN = rf"""((?i:{NAMES}))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX, BARE = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}", "[A-Za-z0-9+/_=-]{20,}"
ASSIGN_LEAST, EXAMPLE_OWNERS, EXAMPLE_REPOS, REDACTED = 6, 3, 20, "[SECRET]"
PATTERNS = (ASSIGN, ACCESS, HEX, BARE)
OWNED = KINDS.index("owned")
CHUNK = 4096  # characters of a text in which spans are replaced together


def matched(text: Column, rank: int) -> Column:
    """array<struct<rank, i, m, gap>> of the matches of a kind: the match and the length of what lies before it."""
    pattern = PATTERNS[rank]
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), gaps.alias("gap"))
    found = F.transform(F.filter(both, lambda x: x["m"].isNotNull()), lambda x, i: F.struct(F.lit(rank).alias("rank"), i.alias("i"), x["m"].alias("m"), x["gap"].alias("gap")))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<rank:int,i:int,m:string,gap:int>>"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str | None = None, owner_col: str = "source", keep: bool = False) -> DataFrame:
    """(n, doc_id, repo, owner, parts) of every row and, with keep=True, the whole row as r; n numbers the rows.

    Computed once, in the shared folder."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = [F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("r")] if keep else []
    parts = F.concat(*[matched(text, rank) for rank in range(len(KINDS))])
    return cut(docs.select(F.monotonically_increasing_id().alias("n"), F.col(id_col).alias("doc_id"), F.col(repo_col or id_col).cast("string").alias("repo"), F.col(owner_col).cast("string").alias("owner"), parts.alias("parts"), *whole))


def spans(scanned: DataFrame) -> DataFrame:
    """(n, repo, owner, start, rank, end, value) of the base spans and of the bare candidates that touch none."""
    m = scanned.filter(F.size("parts") > 0).select("n", "repo", "owner", F.explode("parts").alias("p")).select("n", "repo", "owner", "p.*").repartition("n")
    size = F.length("m").cast("long")
    end = F.sum(F.col("gap") + size).over(Window.partitionBy("n", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    value = F.when(F.col("rank") == 0, F.regexp_extract("m", ASSIGN, 2)).otherwise(F.col("m"))
    found = m.select("n", "repo", "owner", "rank", end.alias("end"), size.alias("size"), value.alias("value"))
    found = found.withColumn("start", F.col("end") - F.col("size"))
    good = F.when(F.col("rank") == 0, F.length("value") >= ASSIGN_LEAST).when(F.col("rank") == OWNED, F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")).otherwise(F.lit(True))
    found = found.filter(good)
    # of what starts before or with a candidate the farthest end, and of what starts with or after it the first start
    base = F.col("rank") < OWNED
    ahead, behind = Window.partitionBy("n").orderBy("start"), Window.partitionBy("n").orderBy(F.desc("start"))
    found = found.withColumn("reach", F.max(F.when(base, F.col("end"))).over(ahead)).withColumn("next", F.min(F.when(base, F.col("start"))).over(behind))
    apart = (F.coalesce("reach", F.lit(-1)) <= F.col("start")) & (F.col("next").isNull() | (F.col("next") >= F.col("end")))
    return found.filter(base | apart).select("n", "repo", "owner", "start", "rank", "end", "value")


def judged(scanned: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """(n, start, rank, end, kind, live, n_repos, n_owners): all base spans and those that the method adds."""
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]")
    kind = F.element_at(F.array(*[F.lit(x) for x in KINDS]), F.col("rank") + 1)
    found = spans(scanned).select("n", "repo", "owner", F.sha2(F.col("value").cast("binary"), 256).alias("hash"), "start", "rank", "end", kind.alias("kind"), mixed.alias("mixed"))
    once = found.groupBy("hash", "owner", "repo").agg(F.max(F.col("rank") < OWNED).alias("base"))
    stats = once.groupBy("hash", "owner").agg(F.count("repo").alias("repos"), F.max("base").alias("base")).groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count("owner").alias("n_owners"), F.max("base").alias("credential"))
    verdict = split_join(found, stats, "hash").withColumn("live", (F.col("n_owners") < example_owners) & (F.col("n_repos") < example_repos))
    return verdict.filter((F.col("rank") < OWNED) | F.col("live") & (F.col("mixed") | F.col("credential"))).select("n", "start", "rank", "end", "kind", "live", "n_repos", "n_owners")


def _joined(col: Column) -> Column:
    return F.array_join(F.transform(col, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str | None = None, owner_col: str = "source", example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base (as kind:start:end), spans (likewise), n_live, n_example."""
    scanned = scan(docs, id_col, text_col, repo_col, owner_col)
    count = lambda x, name: F.count_if(x).alias(name)
    counts = [count(F.col("rank") == k, f"n_{x}") for k, x in enumerate(KINDS[:OWNED])] + [count(F.col("live"), "n_live"), count(~F.col("live"), "n_example")]
    verdict = judged(scanned, example_owners, example_repos).groupBy("n").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("all"), *counts)
    zero = lambda x: F.coalesce(x, F.lit(0)).cast("long").alias(x)
    text = lambda x: F.coalesce(_joined(x), F.lit(""))
    base = F.filter("all", lambda x: x["rank"] < OWNED)
    return scanned.select("n", "doc_id").join(verdict, "n", "left").select("doc_id", *[zero(f"n_{x}") for x in KINDS[:OWNED]], text(base).alias("base"), text(F.col("all")).alias("spans"), zero("n_live"), zero("n_example"))


def redact(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", owner_col: str = "source", repo_col: str | None = None, example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS, mark: str = REDACTED) -> DataFrame:
    """All rows and columns of docs, each live-looking span of a text replaced by mark; examples stay. Spans that
    overlap are replaced together.

    Only rows with a possible match are scanned in full and joined; the others pass as they are."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    suspect = reduce(lambda a, b: a | b, [text.rlike(x) for x in PATTERNS])
    scanned = scan(docs.filter(suspect), id_col, text_col, repo_col, owner_col, keep=True)
    live = judged(scanned, example_owners, example_repos).filter("live").select("n", "start", "end")
    before = F.max("end").over(Window.partitionBy("n").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    live = live.withColumn("new", (F.col("start") >= F.coalesce(before, F.lit(0))).cast("int"))
    live = live.withColumn("part", F.sum("new").over(Window.partitionBy("n").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)))
    live = live.groupBy("n", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    # texts are taken in chunks, so that no place is looked up from the start of a long text
    last = F.floor((F.col("end") - 1) / CHUNK)
    by = live.select("n", "start", "end", F.explode(F.sequence(F.floor(F.col("start") / CHUNK), last)).alias("c"))
    at = lambda x: (x - F.col("c") * CHUNK).cast("int")
    local = F.struct(F.greatest(at(F.col("start")), F.lit(0)).alias("a"), F.least(at(F.col("end")), F.lit(CHUNK)).alias("b"), (at(F.col("start")) >= 0).alias("first"))
    by = by.groupBy("n", "c").agg(F.array_sort(F.collect_list(local)).alias("spans")).groupBy("n").agg(F.map_from_entries(F.collect_list(F.struct(F.col("c").cast("int"), "spans"))).alias("live"))
    whole = F.col(f"r.`{text_col}`")

    def cleaned(chunk: Column, c: Column) -> Column:
        held = F.col("live")[c]

        def step(acc: Column, x: Column) -> Column:
            ahead = F.substring(chunk, acc["at"] + 1, x["a"] - acc["at"])
            return F.struct(x["b"].alias("at"), F.concat(acc["out"], ahead, F.when(x["first"], F.lit(mark)).otherwise(F.lit(""))).alias("out"))

        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        rest = lambda acc: F.concat(acc["out"], F.substring(chunk, acc["at"] + 1, F.lit(CHUNK)))
        return F.when(held.isNull(), chunk).otherwise(F.aggregate(held, start, step, rest))

    chunks = F.regexp_extract_all(whole, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    new = F.when(F.col("live").isNotNull(), F.array_join(F.transform(chunks, cleaned), "")).otherwise(whole)
    rows = scanned.select("n", "r").join(by, "n", "left").withColumn("new", new)
    return docs.filter(~suspect).unionByName(rows.select(*[F.col("new").alias(x) if x == text_col else F.col(f"r.`{x}`").alias(x) for x in docs.columns]))
