"""URL filtering by rules and, where none fits, by gradient-boosted trees on lexical features.

Rules name a host and a path and hold for the host's subdomains too; the longest
that fits decides. All other URLs are judged by trees learned from labelled ones.
DataFrame functions only: the features are column expressions cut into at most 32
bins by fixed formulas, so nothing depends on a sample of the data; a level of a
tree is one aggregate (gradients and curvatures by node, feature and bin) over
all labelled URLs, of which the driver gets nodes x features x bins sums; a
tree is a CASE expression over the bins. Gradients are added as integers, so the
trees don't depend on how the rows are partitioned.

The suffix statistics are the shares of blocked URLs among the labelled ones
with the same last host label, last two labels, first path segment, or file
ending. They are kept for hashed buckets, whose number bounds what is broadcast
at every size. A labelled URL's own statistics leave its fold out, so that it
does not see its own label.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handover.llm import scratch

BUCKETS = 4_096  # of each suffix statistic
FOLDS = 5
BINS = 32
TREES, DEPTH, RATE = 16, 3, 0.3
_SHRINK = 1.0  # curvature added to each side of a split
_PRIOR = 10.0  # rows at the overall share added to each suffix statistic
_UNIT = 1 << 20  # gradients are integers of this part
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    rest = F.coalesce(F.regexp_extract(url, "(?s)://(.*)", 1), F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (null if none does); of equally long ones the first given.

    One test for each rule, so lists of up to some hundreds of rules.
    """
    ordered = sorted(rules, key=lambda r: -len(r.name))
    pick = lambda what: F.coalesce(*(F.when(r.fits(host, path), F.lit(what(r))) for r in ordered), F.lit(None).cast("string"))
    return pick(lambda r: r.name), pick(lambda r: r.verdict)


# --- features


def _entropy(text: Column) -> Column:
    """Bits of entropy of the text's characters, from the runs of the sorted characters."""
    sorted_ = F.array_sort(F.split(text, "", -1))
    term = lambda run: run * F.log2(F.greatest(run, F.lit(1.0)))
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))

    def step(acc: Column, c: Column) -> Column:
        same = acc["last"] == c
        return F.struct(c.alias("last"), F.when(same, acc["run"] + 1).otherwise(1.0).alias("run"), (acc["sum"] + F.when(same, 0.0).otherwise(term(acc["run"]))).alias("sum"))

    total = F.aggregate(sorted_, start, step, lambda acc: acc["sum"] + term(acc["run"]))
    n = F.length(text).cast("double")
    return F.when(n > 0, F.greatest(F.log2(n) - total / n, F.lit(0.0))).otherwise(0.0)


def _bin(x: Column) -> Column:
    return F.least(F.greatest(F.floor(x), F.lit(0)), F.lit(BINS - 1)).cast("int")


def _octaves(n: Column) -> Column:
    """Four bins for each doubling."""
    return _bin(4 * F.log2(F.greatest(n, F.lit(1)).cast("double")))


#: Suffix statistics: what of the host and the path each one goes by.
SUFFIXES = ("last_label", "last_two_labels", "first_segment", "file_ending")
SHAPE = ("length", "host_length", "path_length", "depth", "labels", "digits", "entropy", "parameters", "dashes")
FEATURES = (*SHAPE, *SUFFIXES)


def shape(rows: DataFrame) -> DataFrame:
    """``rows`` (url, host, path, ...) with the bins of ``SHAPE`` and the buckets (``s_...``) of ``SUFFIXES``."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    count = lambda text, pattern: F.length(F.regexp_replace(text, pattern, ""))
    query = F.regexp_extract(url, "^[^?#]*\\?([^#]*)", 1)
    labels, segments = F.split(host, "\\.", -1), F.split(path, "/", -1)
    bucket = lambda kind, text: F.pmod(F.xxhash64(F.lit(kind), text), F.lit(BUCKETS)).cast("int")
    keys = {
        "last_label": F.element_at(labels, -1),
        "last_two_labels": F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), "."),
        "first_segment": F.coalesce(F.get(segments, F.lit(1)), F.lit("")),
        "file_ending": F.regexp_extract(F.element_at(segments, -1), "\\.([^.]*)$", 1),
    }
    return rows.select(
        "*",
        _octaves(F.length(url)).alias("length"),
        _octaves(F.length(host)).alias("host_length"),
        _octaves(F.length(path)).alias("path_length"),
        _bin(count(path, "[^/]+")).alias("depth"),
        _bin(count(host, "[^.]+")).alias("labels"),
        _bin(BINS * count(url, "[^0-9]+") / F.greatest(F.length(url), F.lit(1))).alias("digits"),
        _bin(5 * _entropy(url)).alias("entropy"),
        _bin(F.when(query == "", 0).otherwise(count(query, "[^&]+") + 1)).alias("parameters"),
        _bin(count(url, "[^-]+")).alias("dashes"),
        *(bucket(k, keys[k]).alias(f"s_{k}") for k in SUFFIXES),
    )


def _fold(url: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(url, F.lit("")), F.lit("fold")), F.lit(FOLDS)).cast("int")


def suffix_rates(labelled: DataFrame) -> DataFrame:
    """(kind, bucket, fold, rate) from shaped URLs with ``blocked`` (0/1): the bins of the smoothed shares of blocked ones.

    Fold -1 counts all URLs, another fold all but its own. At most kinds x
    BUCKETS x (FOLDS + 1) rows.
    """
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"s_{k}").alias("bucket")) for k in SUFFIXES))
    each = labelled.select(_fold(F.col("url")).alias("fold"), "blocked", F.explode(kinds).alias("k")).select("k.*", "fold", "blocked")
    counts = scratch.write(each.groupBy("kind", "bucket", "fold").agg(F.count("*").alias("n"), F.sum("blocked").alias("b")), "url-suffixes")
    whole = counts.groupBy("kind", "bucket").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    all_ = whole.where(F.col("kind") == SUFFIXES[0]).agg(F.sum("n").alias("n"), F.sum("b").alias("b")).first()
    share = (all_["b"] or 0) / max(all_["n"] or 0, 1)
    rest = whole.select("*", F.explode(F.array(*(F.lit(f) for f in range(-1, FOLDS)))).alias("fold"))
    own = counts.select("kind", "bucket", "fold", F.col("n").alias("own_n"), F.col("b").alias("own_b"))
    rest = rest.join(own, ["kind", "bucket", "fold"], "left")
    n, b = F.col("n") - F.coalesce("own_n", F.lit(0)), F.col("b") - F.coalesce("own_b", F.lit(0))
    return scratch.write(rest.select("kind", "bucket", "fold", _bin(BINS * (b + _PRIOR * share) / (n + _PRIOR)).alias("rate")), "url-rates")


def _with_rates(rows: DataFrame, rates: DataFrame, fold: Column, unseen: int) -> DataFrame:
    """The bins of ``SUFFIXES`` for shaped rows."""
    rows = rows.withColumn("f", fold)
    for k in SUFFIXES:
        of = rates.where(F.col("kind") == k).select(F.col("bucket").alias(f"s_{k}"), F.col("fold").alias("f"), F.col("rate").alias(k))
        rows = rows.join(F.broadcast(of), [f"s_{k}", "f"], "left")  # BUCKETS x (FOLDS + 1) rows at most
    return rows.fillna(unseen, list(SUFFIXES)).drop("f")


# --- trees


@dataclass
class Tree:
    """A split (rows with a larger bin go right) or, without a feature, a leaf."""

    feature: str | None = None
    bin: int = 0
    value: float = 0.0
    sides: list["Tree"] = field(default_factory=list)

    def expression(self) -> Column:
        if self.feature is None:
            return F.lit(self.value)
        return F.when(F.col(self.feature) > self.bin, self.sides[1].expression()).otherwise(self.sides[0].expression())

    def leaves(self) -> list["Tree"]:
        return [x for s in self.sides for x in s.leaves()] if self.feature else [self]


@dataclass
class Model:
    base: float
    trees: list[Tree]
    rates: DataFrame | None
    unseen: int = 0  # the bin of a suffix that no labelled URL has

    def margin(self) -> Column:
        return reduce(lambda a, t: a + t.expression(), self.trees, F.lit(self.base))


def _split(sums: dict[tuple[str, int], tuple[int, int]]) -> tuple[str, int, tuple[float, float, float, float]] | None:
    """The best (feature, bin) of one node, with the sides' gradients and curvatures; None if none gains."""
    best, gained = None, 1e-6
    part = lambda g, h: g * g / (h + _SHRINK)
    for f in FEATURES:
        bins = sorted(b for name, b in sums if name == f)
        all_g, all_h = (sum(sums[f, b][i] for b in bins) / _UNIT for i in (0, 1))
        left_g = left_h = 0
        for b in bins[:-1]:
            left_g, left_h = left_g + sums[f, b][0], left_h + sums[f, b][1]
            g, h = left_g / _UNIT, left_h / _UNIT
            gain = part(g, h) + part(all_g - g, all_h - h) - part(all_g, all_h)
            if gain > gained:
                best, gained = (f, b, (g, h, all_g - g, all_h - h)), gain
    return best


def _numbered(tree: Tree, leaves: list[Tree]) -> Column:
    """Number of the leaf that a row is in."""
    if tree.feature is None:
        return F.lit(next(i for i, x in enumerate(leaves) if x is tree))
    return F.when(F.col(tree.feature) > tree.bin, _numbered(tree.sides[1], leaves)).otherwise(_numbered(tree.sides[0], leaves))


def boost(binned: DataFrame, base: float, trees: int, depth: int, rate: float) -> list[Tree]:
    """Trees on (FEATURES, blocked, n): rows of equal bins and label are one row with their number."""
    grown: list[Tree] = []
    for _ in range(trees):
        p = 1 / (1 + F.exp(-Model(base, grown, None).margin()))
        whole = lambda x: F.round(x * _UNIT).cast("long") * F.col("n")
        rows = binned.select(*FEATURES, whole(F.col("blocked") - p).alias("g"), whole(F.greatest(p * (1 - p), F.lit(1e-6))).alias("h"))
        tree = Tree()
        for _ in range(depth):
            leaves = tree.leaves()
            pairs = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES))
            sums = rows.select(_numbered(tree, leaves).alias("leaf"), "g", "h", F.explode(pairs).alias("p")).groupBy("leaf", "p.feature", "p.bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            by_leaf: dict[int, dict] = {}
            for r in sums.collect():  # leaves x features x BINS rows at most
                by_leaf.setdefault(r["leaf"], {})[r["feature"], r["bin"]] = (r["g"], r["h"])
            found = {i: s for i, x in by_leaf.items() if (s := _split(x))}
            for i, (feature, b, (lg, lh, rg, rh)) in found.items():
                leaf = leaves[i]
                leaf.feature, leaf.bin = feature, b
                leaf.sides = [Tree(value=rate * lg / (lh + _SHRINK)), Tree(value=rate * rg / (rh + _SHRINK))]
            if not found:
                break
        if tree.feature is None:  # nothing left to gain
            break
        grown.append(tree)
    return grown


def train(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Model:
    """A model from all rows of ``labelled`` (url, host, path, blocked 0/1; null labels are left out).

    Repeated rows count as often as they occur. Without a labelled row the model
    has no trees and says 0 for every URL, which allows it.
    """
    rows = scratch.write(shape(labelled.where("blocked is not null").select("url", "host", "path", F.col("blocked").cast("int"))), "labelled-urls")
    whole = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("b")).first()
    n, b = whole["n"], whole["b"]
    if not n:
        return Model(0.0, [], None)
    rates = suffix_rates(rows)
    unseen = min(int(BINS * b / n), BINS - 1)
    binned = _with_rates(rows, rates, _fold(F.col("url")), unseen).groupBy(*FEATURES, "blocked").agg(F.count("*").alias("n"))
    base = F.log((F.lit(b) + 0.5) / (F.lit(n - b) + 0.5))
    base = float(rows.sparkSession.range(1).select(base.alias("x")).first()["x"])
    return Model(base, boost(scratch.write(binned, "url-bins"), base, trees, depth, rate), rates, unseen)


def predict(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (url, host, path, ...) with ``score``, the probability of being blocked."""
    keep = rows.columns
    if model.rates is None:
        return rows.withColumn("score", F.lit(1.0) / (1 + F.exp(-F.lit(model.base))))
    binned = _with_rates(shape(rows), model.rates, F.lit(-1), model.unseen)
    return binned.select(*(F.col(f"`{c}`") for c in keep), (1 / (1 + F.exp(-model.margin()))).alias("score"))


def filter_urls(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None, url: str = "url", key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict, score), a row for each row of ``pages``.

    ``verdict`` is the rule's, else ``block`` for scores of one half or more.
    ``labelled``: (url, blocked); without it the URLs that a rule decides are the
    labelled ones. Null URLs and URLs without ``://`` have empty host and path and
    are judged by the trees (a null as an empty URL). An empty path starts with
    no rule's path but the empty one. Long URLs are read whole. Repeated rows are
    judged alike and stay. An empty table gives no rows. Other columns are not
    read, so their names can't clash.
    """
    parsed = lambda df, *more: df.select(*more, *(x.alias(n) for x, n in zip(host_and_path(F.col("url")), ("host", "path"))))
    rows = parsed(pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url")), "key", "url")
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", name.alias("rule"), verdict.alias("ruled"))
    known = rows.select("url", "host", "path", (F.col("ruled") == "block").cast("int").alias("blocked")) if labelled is None else parsed(labelled.select("url", "blocked"), "url", "blocked")
    judged = predict(rows, train(known))
    verdict = F.coalesce("ruled", F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    return judged.select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict"), "score")
