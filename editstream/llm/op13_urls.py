"""URL filter: written rules first, then a tree of path templates for each host.

A rule (host and path) fits its host and all subdomains where the path starts
with the rule's; the longest one that fits decides. Other urls are judged by
their template:

1. A segment's form has ``#`` for each stretch of digits. At each level of a
   host, forms that hold at least a ``SHARE`` of the host's urls (two at least)
   are constant; all others are variable and become ``*``. From level ``DEPTH``
   on a path is ``**``.
2. The templates of a host make a tree of its ``NODES`` heaviest nodes; a url
   belongs to the deepest node on its way.
3. Sibling branches merge, from the top down, where no share differs more than
   Hoeffding's bound allows: those of urls that end there, of labels, of
   children, and so on below. Branches of less than ``LEAST`` urls are too
   small to tell and stay apart.
4. Labels are the decisions of the rules, and block for hosts with a word of
   ``SEED_WORDS`` that no rule decides (parameters). A merged template is
   rejected where ``(block + 1) / (block + allow + 2)`` is at least ``REJECT``:
   one without labels, or with a single one, is not.

A host's model (its constants and nodes) is bounded by these parameters. Urls
meet it in a join on the host: models of the hosts with most urls are broadcast
while they fit ``BROADCAST_BYTES``, so a host with a third of all urls is not
shuffled; the other hosts are. Counts are summed before each shuffle, and the
heaviest forms and nodes are chosen in each task before they meet.

Defined cases: a null url, or one without ``://``, has an empty host and path
and is judged like other urls of that host; an empty path has no segments;
repeated rows and null ids are urls each; urls of any length are read whole; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .shared import discard, read_table, stored

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
SEED_WORDS = ("adult", "casino", "porn", "spam", "viagra", "xxx")

SHARE = 64            # a constant form holds a 64th of its host's urls
LONGEST_FORM = 64     # characters of a constant form
DEPTH = 8
NODES = 1024
LEAST = 8
ERROR = 0.05          # of Hoeffding's bound
REJECT = 0.75
BROADCAST_BYTES = 32 << 20
HOT = 1024            # a hot host has more than a 1024th of all urls

NODE = "host string, node string, verdict string, purity double, template string"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; only A-Z are lowered."""
    host = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as text, its verdict) of the longest rule that fits, or nulls."""
    text = verdict = F.lit(None).cast("string")
    for at, prefix, says in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(prefix)
        text = F.when(fits, F.lit(at + prefix)).otherwise(text)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def _meet(rows: DataFrame, models: DataFrame, weight: str, payload: str) -> DataFrame:
    """``rows`` beside their host's ``payload``. models: host, weight, payload, one row a host.

    Of the hosts with more than a 1024th of the weight (so fewer than 1024), the
    heaviest are broadcast as far as their payloads fit; the rest is shuffled."""
    whole = models.agg(F.sum(weight)).first()[0] or 0
    heavy = W.partitionBy(F.lit(0)).orderBy(F.desc(weight), "host").rowsBetween(W.unboundedPreceding, 0)
    bytes_ = F.octet_length(F.to_json(F.struct(payload))) + F.octet_length("host") + 64
    hot = models.filter(F.col(weight) * HOT > whole).withColumn("_bytes", F.sum(bytes_).over(heavy)).filter(
        F.col("_bytes") <= BROADCAST_BYTES).select("host", payload)
    hot = stored(hot, "hot-hosts")
    near = rows.join(F.broadcast(hot), "host")
    far = rows.join(F.broadcast(hot.select("host")), "host", "left_anti").join(
        models.select("host", payload).hint("merge"), "host")
    return near.unionByName(far)


def _template(forms: Column, constants: Column) -> Column:
    """Forms as an array of constants, ``*``, and ``**`` for what lies deeper."""
    upper = F.transform(F.slice(forms, 1, DEPTH), lambda x, i: F.when(
        F.array_contains(constants, F.concat(i.cast("string"), F.lit("/"), x)), x).otherwise("*"))
    return F.when(F.size(forms) > DEPTH, F.concat(upper, F.array(F.lit("**")))).otherwise(upper)


def _node(template: Column, levels: Column) -> Column:
    """The name of a node: ``/`` before each of its segments."""
    return F.concat_ws("", F.transform(F.slice(template, F.lit(1), levels), lambda x: F.concat(F.lit("/"), x)))


class Branch:
    """A node of a host's tree: urls below and ending here, as (urls, block, allow)."""

    def __init__(self, name: str):
        self.names, self.nodes, self.below, self.ends, self.children = [name], [], (0, 0, 0), (0, 0, 0), {}

    def absorb(self, other: "Branch", sibling: bool) -> None:
        if sibling:
            self.names += other.names
        self.nodes += other.nodes
        self.below, self.ends = (tuple(x + y for x, y in zip(a, b)) for a, b in (
            (self.below, other.below), (self.ends, other.ends)))
        for name, child in other.children.items():
            if name in self.children:
                self.children[name].absorb(child, False)
            else:
                self.children[name] = child


def similar(a: Branch, b: Branch) -> bool:
    """No share of the branches differs beyond Hoeffding's bound, here or below."""
    n, m = a.below[0], b.below[0]
    if min(n, m) < LEAST:
        return False
    bound = math.sqrt(0.5 * math.log(2 / ERROR)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
    none = Branch("")
    pairs = [(a.children.get(c, none), b.children.get(c, none)) for c in sorted(a.children.keys() | b.children.keys())]
    counts = [(a.ends[0], b.ends[0]), (a.below[1], b.below[1]), (a.below[2], b.below[2])]
    counts += [(x.below[0], y.below[0]) for x, y in pairs]
    if any(abs(x / n - y / m) >= bound for x, y in counts):
        return False
    # Too few urls below say nothing against a merge.
    return all(similar(x, y) for x, y in pairs if min(x.below[0], y.below[0]) >= LEAST)


def merge_branches(branch: Branch) -> None:
    """Merges similar children, the heaviest first, then theirs."""
    groups: list[Branch] = []
    for _, child in sorted(branch.children.items(), key=lambda c: (-c[1].below[0], c[0])):
        for group in groups:
            if similar(group, child):
                group.absorb(child, True)
                break
        else:
            groups.append(child)
    branch.children = {g.names[0]: g for g in groups}
    for g in groups:
        merge_branches(g)


def judged_nodes(nodes: list[tuple]) -> list[tuple]:
    """(node, urls, block, allow) of one host, parents included -> (node, verdict, purity, template)."""
    root, at = Branch(""), {}
    for node, *counts in sorted(nodes, key=lambda r: r[0].count("/")):
        above, _, name = node.rpartition("/")
        branch = at[node] = root if not node else at[above].children.setdefault(name, Branch(name))
        branch.nodes, branch.below, branch.ends = [node], tuple(counts), tuple(counts)
        if node:
            at[above].ends = tuple(x - y for x, y in zip(at[above].ends, counts))
    merge_branches(root)
    out, todo = [], [(root, "")]
    while todo:
        branch, above = todo.pop()
        names = sorted(branch.names)
        template = above + ("" if branch is root else "/" + (names[0] if len(names) == 1 else "{" + "|".join(names) + "}"))
        _, block, allow = branch.ends
        purity = (block + 1) / (block + allow + 2)
        out += [(node, "block" if purity >= REJECT else "allow", purity, template) for node in branch.nodes]
        todo += [(child, template) for child in branch.children.values()]
    return out


def _judged(batches):
    """Nodes sorted by host -> ``NODE`` rows; a host may lie across batches."""
    import pyarrow as pa

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("host", "node", "n", "block", "allow")))

    def table(found):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)],
                                          names=["host", "node", "verdict", "purity", "template"])

    import itertools

    found = []
    for host, group in itertools.groupby(rows(), key=lambda r: r[0]):
        found += [(host, *j) for j in judged_nodes([r[1:] for r in group])]
        if len(found) >= 8192:
            yield table(found)
            found = []
    if found:
        yield table(found)


def judge_urls(pages: DataFrame, rules=RULES, seed_words=SEED_WORDS) -> DataFrame:
    """pages: page_id, url -> page_id, host, path, rule, verdict, template, purity.

    ``template`` and ``purity`` are those of the url's template, also where a rule decides.
    """
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    rows = split.select(
        "page_id", "host", "path", rule.alias("rule"), says.alias("says"),
        # The first segment is behind the first slash; an empty path has none.
        F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(
            F.split(F.regexp_replace(F.substr("path", F.lit(2)), "[0-9]+", "#"), "/")).alias("forms"))
    seeded = F.arrays_overlap(F.split("host", "[.-]"), F.array(*[F.lit(w) for w in seed_words])) if seed_words else F.lit(False)
    label = F.coalesce("says", F.when(seeded, "block"))
    one = lambda c: F.sum(c.cast("long"))
    urls = stored(rows.groupBy("host", "forms").agg(
        F.count(F.lit(1)).alias("n"), one(F.coalesce(label == "block", F.lit(False))).alias("block"),
        one(F.coalesce(label == "allow", F.lit(False))).alias("allow")), "url-forms")

    hosts = urls.groupBy("host").agg(F.sum("n").alias("urls"))
    level = W.partitionBy("host", "level").orderBy(F.desc("n"), "form")
    frequent = (urls.select("host", "n", F.posexplode(F.slice("forms", 1, DEPTH)).alias("level", "form"))
                .filter(F.char_length("form") <= LONGEST_FORM)
                .groupBy("host", "level", "form").agg(F.sum("n").alias("n")).filter("n >= 2")
                .withColumn("at", F.row_number().over(level)).filter(F.col("at") <= SHARE))
    constants = hosts.join(frequent, "host", "left").filter(F.col("n").isNull() | (F.col("n") * SHARE >= F.col("urls"))).groupBy(
        "host", "urls").agg(F.collect_list(F.concat(F.col("level").cast("string"), F.lit("/"), F.col("form"))).alias("constants"))
    # A host whose frequent forms all fall short of the share has no row yet.
    constants = stored(hosts.join(constants.drop("urls"), "host", "left").select(
        "host", "urls", F.coalesce("constants", F.array().cast("array<string>")).alias("constants")), "url-constants")

    templates = _meet(urls, constants, "urls", "constants").select(
        "host", "n", "block", "allow", _template(F.col("forms"), F.col("constants")).alias("template")).groupBy(
        "host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "block", "allow")])
    heaviest = W.partitionBy("host").orderBy(F.desc("n"), "levels", "node")
    nodes = (templates.select("host", "n", "block", "allow", "template",
                              F.explode(F.sequence(F.lit(0), F.size("template"))).alias("levels"))
             .groupBy("host", "levels", _node(F.col("template"), F.col("levels")).alias("node"))
             .agg(*[F.sum(c).alias(c) for c in ("n", "block", "allow")])
             # A node has no more urls than the one above it, so the heaviest make a tree.
             .withColumn("at", F.row_number().over(heaviest)).filter(F.col("at") <= NODES))
    judged = nodes.select("host", "node", "n", "block", "allow").repartition("host").sortWithinPartitions("host").mapInArrow(
        _judged, NODE)
    models = judged.groupBy("host").agg(F.map_from_entries(F.collect_list(
        F.struct("node", F.struct("verdict", "purity", "template")))).alias("nodes"))
    models = stored(constants.join(models, "host").select(
        "host", "urls", F.struct("constants", "nodes").alias("model")), "url-models")

    template = _template(F.col("forms"), F.col("model.constants"))
    ways = F.transform(F.sequence(F.size("way"), F.lit(0), F.lit(-1)),
                       lambda k: F.element_at(F.col("model.nodes"), _node(F.col("way"), k)))
    found = _meet(rows, models, "urls", "model").withColumn("way", template).select(
        "page_id", "host", "path", "rule", "says", F.filter(ways, lambda x: x.isNotNull())[0].alias("node"))
    result = stored(found.select("page_id", "host", "path", "rule", F.coalesce("says", "node.verdict").alias("verdict"),
                                 "node.template", "node.purity"), "url-verdicts")
    discard(urls, constants, models)
    return result


def op13_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of each page."""
    return judge_urls(read_table(spark, sf_dir, "pages"))
