"""URL verdicts by rules and, where no rule fits, by a path-template tree; DataFrame functions only.

The tree is built level by level under each host. A segment first takes its shape (runs of digits and long
hexadecimal runs become signs). At each node with many children, the rare ones are variable and become the
wildcard `*`; then branches whose labelled share of blocked pages cannot be told from that of the node's
best labelled branch (a two-proportion test) merge with it. Segments below `DEPTH` stay together as one.
Labels are the verdicts of the rules. A template is rejected when its share of blocked pages, smoothed by
a prior that leans towards allowing, reaches `REJECT`; pages of rejected templates are blocked, others allowed.

All counts run over distinct shaped paths that are counted before the shuffle, so a host with a third of the
pages is a few rows for each map task. The tree has one row for each shaped path and is written to the shared
folder after each level. Null urls and urls without `://` have empty host and path, no rule,
and are judged by the template of the empty host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import cut

#: Fixed values of the contract: verdict and rule, host before the first slash, path from it on.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))

#: Levels that have nodes of their own.
DEPTH = 3
#: A node with this many children may have variable ones: those under a tenth of its pages.
MANY_CHILDREN = 10
RARE_SHARE = 10
#: Labelled pages that a branch needs to be compared; the test's critical value.
LEAST_LABELS = 5
CRITICAL = 3.84
#: Prior: PRIOR_BLOCK of PRIOR_PAGES imagined pages are blocked. Purity from which a template is rejected.
PRIOR_BLOCK = 1
PRIOR_PAGES = 5
REJECT = 0.6

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased in A-Z, and path of a url."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(has, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(RULES, key=lambda r: len(r[1])):
        name, slash, tail = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + tail)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def shape(path: Column) -> Column:
    """Segments of a path with long hexadecimal runs and digits replaced by signs; those below DEPTH joined."""
    signs = F.regexp_replace(F.regexp_replace(path, "[0-9a-f]{16,}", "<hex>"), "[0-9]+", "<n>")
    parts = F.split(F.regexp_replace(signs, "^/", ""), "/")
    tail = F.array_join(F.slice(parts, DEPTH + 1, F.greatest(F.size(parts) - DEPTH, F.lit(0))), "/")
    return F.concat(F.slice(parts, 1, DEPTH), F.when(F.size(parts) > DEPTH, F.array(tail)).otherwise(F.array().cast("array<string>")))


def _similar(b1: str, n1: str, b2: str, n2: str) -> str:
    """Two-proportion test as a condition without division, in floating point."""
    b1, n1, b2, n2 = (f"cast({x} as double)" for x in (b1, n1, b2, n2))
    both = f"({b1} + {b2}) * ({n1} + {n2} - {b1} - {b2}) * {n1} * {n2}"
    return f"({b1} * {n2} - {b2} * {n1}) * ({b1} * {n2} - {b2} * {n1}) * ({n1} + {n2}) <= cast({CRITICAL} as double) * {both}"


def build_templates(shaped: DataFrame) -> DataFrame:
    """From (host, parts, pages, blocked, labelled), one row for each shape: host, parts, template."""
    tree = cut(shaped.withColumn("prefix", F.lit("")))
    for level in range(DEPTH + 1):
        tree = tree.withColumn("seg", F.get("parts", F.lit(level)))
        child = tree.groupBy("host", "prefix", "seg").agg(*[F.sum(c).alias(c) for c in ("pages", "blocked", "labelled")])
        node = child.groupBy("host", "prefix").agg(F.count("seg").alias("children"), F.sum("pages").alias("node_pages"))
        child = child.join(node, ["host", "prefix"]).withColumn(
            "general", F.when((F.col("children") >= MANY_CHILDREN) & (F.col("pages") * RARE_SHARE < F.col("node_pages")) & F.col("seg").isNotNull(), F.lit("*")).otherwise(F.col("seg"))
        )
        branch = child.groupBy("host", "prefix", "general").agg(F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"))
        best = branch.where("general is not null").groupBy("host", "prefix").agg(F.max(F.struct("labelled", "general", "blocked")).alias("best"))
        same = f"labelled >= {LEAST_LABELS} and best.labelled >= {LEAST_LABELS} and {_similar('blocked', 'labelled', 'best.blocked', 'best.labelled')}"
        branch = branch.join(best, ["host", "prefix"], "left").select(
            "host", "prefix", "general", F.when(F.col("general").isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), F.expr(f"case when {same} then best.general else general end"))).alias("step")
        )
        steps = child.select("host", "prefix", "seg", "general").join(
            branch.withColumnsRenamed({"host": "h", "prefix": "p", "general": "g"}),
            F.col("host").eqNullSafe(F.col("h")) & F.col("prefix").eqNullSafe(F.col("p")) & F.col("general").eqNullSafe(F.col("g")),
        ).select(F.col("host").alias("h"), F.col("prefix").alias("p"), F.col("seg").alias("s"), "step")
        tree = (
            tree.join(steps, (F.col("host") == F.col("h")) & (F.col("prefix") == F.col("p")) & F.col("seg").eqNullSafe(F.col("s")))
            .withColumn("prefix", F.concat("prefix", "step"))
            .drop("h", "p", "s", "step", "seg")
        )
        tree = cut(tree)  # a level reads the one above several times
    return tree.withColumnRenamed("prefix", "template")


def judge_urls(df: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule, verdict, template, purity for every row."""
    base = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{url}`").cast("string").alias("_url"))
    host, path = host_and_path(F.col("_url"))
    base = base.select("_key", host.alias("host"), path.alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"))
    base = base.select("_key", "host", "path", rule.alias("rule"), said.alias("said"), shape(F.col("path")).alias("parts"))
    shaped = base.groupBy("host", "parts").agg(
        F.count(F.lit(1)).alias("pages"), F.count(F.when(F.col("said") == "block", 1)).alias("blocked"), F.count("said").alias("labelled")
    )
    tree = build_templates(shaped)
    purity = (F.sum("blocked") + PRIOR_BLOCK) / (F.sum("labelled") + PRIOR_PAGES)
    judged = tree.groupBy("host", "template").agg(purity.alias("purity"))
    by_shape = tree.select("host", "parts", "template").join(judged, ["host", "template"])
    out = base.join(by_shape, ["host", "parts"])
    learned = F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return out.select(F.col("_key").alias(key), "host", "path", "rule", F.coalesce("said", learned).alias("verdict"), "template", "purity")


def oracle_sql() -> str:
    """The same tree and verdicts in DuckDB's SQL, over `pages`."""
    rules = sorted(RULES, key=lambda r: -len(r[1]))

    def pick(values: list[str]) -> str:
        cases = []
        for value, (_, text) in zip(values, rules, strict=True):
            name, slash, tail = text.partition("/")
            cases.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{tail}') THEN '{value}'")
        return f"CASE {' '.join(cases)} END"

    steps = [f"""
        urls AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        split AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls),
        said AS (SELECT *, {pick([t for _, t in rules])} AS rule, {pick([v for v, _ in rules])} AS said,
            string_split(regexp_replace(regexp_replace(regexp_replace(path, '[0-9a-f]{{16,}}', '<hex>', 'g'), '[0-9]+', '<n>', 'g'), '^/', ''), '/') AS list FROM split),
        base AS MATERIALIZED (SELECT *, list[1:{DEPTH}] || CASE WHEN len(list) > {DEPTH} THEN [array_to_string(list[{DEPTH + 1}:], '/')] ELSE [] END AS parts FROM said),
        t0 AS MATERIALIZED (SELECT host, parts, '' AS prefix, count(*) AS pages, count(*) FILTER (said = 'block') AS blocked, count(said) AS labelled FROM base GROUP BY host, parts)"""]
    for k in range(DEPTH + 1):
        steps.append(f"""
        c{k} AS (SELECT host, prefix, parts[{k + 1}] AS seg, sum(pages) AS pages, sum(blocked) AS blocked, sum(labelled) AS labelled FROM t{k} GROUP BY ALL),
        n{k} AS (SELECT host, prefix, count(seg) AS children, sum(pages) AS node_pages FROM c{k} GROUP BY ALL),
        g{k} AS MATERIALIZED (SELECT c{k}.*, CASE WHEN children >= {MANY_CHILDREN} AND pages * {RARE_SHARE} < node_pages AND seg IS NOT NULL THEN '*' ELSE seg END AS general FROM c{k} JOIN n{k} USING (host, prefix)),
        b{k} AS MATERIALIZED (SELECT host, prefix, general, sum(blocked) AS blocked, sum(labelled) AS labelled FROM g{k} GROUP BY ALL),
        x{k} AS (SELECT * FROM b{k} WHERE general IS NOT NULL QUALIFY row_number() OVER (PARTITION BY host, prefix ORDER BY labelled DESC, general DESC, blocked DESC) = 1),
        s{k} AS (SELECT b.host, b.prefix, b.general, CASE WHEN b.general IS NULL THEN '' ELSE '/' || CASE WHEN b.labelled >= {LEAST_LABELS} AND x.labelled >= {LEAST_LABELS}
            AND {_similar('b.blocked', 'b.labelled', 'x.blocked', 'x.labelled')} THEN x.general ELSE b.general END END AS step FROM b{k} b LEFT JOIN x{k} x ON b.host = x.host AND b.prefix = x.prefix),
        t{k + 1} AS MATERIALIZED (SELECT t.host, t.parts, t.prefix || s.step AS prefix, t.pages, t.blocked, t.labelled FROM t{k} t
            JOIN g{k} g ON t.host = g.host AND t.prefix = g.prefix AND t.parts[{k + 1}] IS NOT DISTINCT FROM g.seg
            JOIN s{k} s ON g.host = s.host AND g.prefix = s.prefix AND g.general IS NOT DISTINCT FROM s.general)""")
    last = f"t{DEPTH + 1}"
    return f"""WITH {",".join(steps)},
        judged AS (SELECT host, prefix, (CAST(sum(blocked) AS DOUBLE) + {PRIOR_BLOCK}) / (CAST(sum(labelled) AS DOUBLE) + {PRIOR_PAGES}) AS purity FROM {last} GROUP BY host, prefix)
        SELECT page_id, host, path, rule, coalesce(said, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict, prefix AS template, purity
        FROM base JOIN {last} USING (host, parts) JOIN judged USING (host, prefix)"""
