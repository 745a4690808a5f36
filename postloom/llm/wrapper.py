"""Problem 6: page boilerplate mixed with main content, by wrapper induction.

A description is read as the text of a page's DOM: the root's children are its lines, a line's children are its
entries (menus, footers) or its whole wording and the beginning and end of it, with digits, hosts and names as slots.
Pages of one host are aligned in pairs by simple tree matching; a child that the alignment finds again on another
page with another text is constant. Constant nodes are the template, nodes that vary are content.

Adverts are made from stock wording too ("What we offer"), so a constant node is not yet furniture. Its role is told by where
the slots of the wrapper are: a page's content begins with its own title (the line that agrees with the record's title) and
ends with its last varying node. Furniture stands before the title or after the content again and again, the
advert's own headings and list entries hardly ever do; a node after the content that names the record's employer, place
or title is no evidence. Both counts are weighed as likelihood ratios per leaf, over all hosts and, where a host's own pages tell
something else with confidence, for that host. A node that is followed by titles of other adverts is the head of a list, and the
titles below it are furniture with it. Only where the ratio is not decisive do the words of a line (:mod:`furniture`) break the tie.

Scale: pages are grouped by host; a host with many pages is cut into shards of about ``SHARD`` pages by a hash
of the posting, so that no host is one task. A page is aligned with its neighbours in three orders (by the rarest node it shares
and by min-hash), so the work is linear; hosts with few pages are aligned with one another. Counts leave a shard
as one row per leaf. The template is broadcast if proven small, else joined to the leaves of all lines.

Defined results: null and empty descriptions have no line; a null or blank url is a host of its own; null titles, names and
places tell nothing; empty lines are no case; on a collection of a single page nothing is constant and nothing is found;
repeated rows are one page with the same result.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import site_host
from postloom.llm.furniture import Roles, items_of
from postloom.llm.residue import DETECTORS, ResidueLines
from postloom.runtime import is_small, materialize, semi_or_salted

SHARD, MIN_VOTES = 400, 2
#: The orders in which the pages of a shard are laid beside each other, besides the one by rarest node: factors of min-hashes.
ORDERS = (0x9E3779B1, 0x85EBCA6B)
#: Hosts with fewer pages are aligned with pages of other such hosts.
FEW = 12
#: Leaves that a template may have to be shipped to every task.
SHIPPED_LEAVES = 300_000
#: How often furniture and content stand before the title, and after the last varying node (likelihood ratios).
ABOVE, BELOW = (0.04, 0.001), (0.3, 0.01)
#: From which score on a node is furniture; up to which distance from 0 words may break the tie; a host's own score that overrules all hosts'.
DECIDED, SURE, OWN = 1.0, 8.0, 6.0

#: Words from which on a line counts as a whole only: a paragraph whose wording varies is content wherever it begins and ends alike.
ENDS = 30

_SLOT = re.compile(r"\d[\d.,:/\-]*|(?<!\S)\S+\.\S{2,}|\b\w\.")
_NAME = re.compile(r"(?<=\s)[A-ZÆØÅÄÖÜ]\w+")
#: A name at the very beginning, followed by another one.
_FIRST = re.compile(r"^[A-ZÆØÅÄÖÜ]\w+(?= N\b)")
#: A label of up to three words, and a value of up to three.
_LABEL = re.compile(r"((?:[^\W\d_][\w.\-]*)(?: [^\W\d_][\w.\-]*){0,2}):(?= )")
_VALUE = re.compile(r" ([^\W\d_]+(?: [^\W\d_]+){0,2})$")
_FOLD = (("æ", "ae"), ("ø", "oe"), ("å", "aa"), ("ä", "ae"), ("ö", "oe"), ("ü", "ue"))
_TERM = re.compile(r"[^\W\d_]{3,}")


class Lines:
    """Leaves and role of a line, remembered (bounded)."""

    def __init__(self, limit: int = 300_000):
        self.roles, self.residue = Roles(limit), ResidueLines(tuple(DETECTORS))
        self.known: dict[str, tuple[str, ...]] = {}
        self.limit = limit

    def leaves(self, line: str) -> tuple[str, ...]:
        out = self.known.get(line)
        if out is None:
            if len(self.known) > self.limit:
                self.known.clear()
            out = self.known[line] = _leaves(line)
        return out


def _leaves(line: str) -> tuple[str, ...]:
    """``i:`` entries, ``l:`` the label of a line, ``w:`` a short line or value, ``s:``, ``b:`` and ``e:`` the whole wording of a longer
    line, its beginning and its end."""
    s = line.strip()
    if not s:
        return ()
    caps = s.upper() == s
    entries = items_of(s)
    if len(entries) >= 3 or (len(entries) == 2 and len(s) < 60):
        return tuple(dict.fromkeys("i:" + _SLOT.sub("0", (e if caps else _NAME.sub("N", e)).lower()) for e in entries))
    s = " ".join(s.split())
    label = None if caps else _LABEL.match(s)
    if label and (value := _VALUE.match(s, label.end())):
        return ("l:" + label[1].lower(), "w:" + value[1].lower())
    bare = s if caps else _NAME.sub("N", s)
    if bare.count(" ") < 3:
        return ("w:" + _SLOT.sub("0", bare).lower(),)
    w = _SLOT.sub("0", _FIRST.sub("N", bare)).lower().split()
    whole = f"s:{len(w)}:" + hashlib.md5(" ".join(w).encode()).hexdigest()[:16]
    if len(w) > ENDS:
        return (whole,)
    return (whole, "l:" + label[1].lower() if label else "b:" + " ".join(w[:3]), "e:" + " ".join(w[-3:]))


Page = list[tuple[int, tuple[str, ...]]]
_VARIES = ("s:",)


def page(text: str, lines: Lines, lengths: set[int] | None = None) -> Page:
    """(line number, leaves) of the lines that are not blank. With the ``lengths`` in words of the template's nodes, paragraphs of
    other lengths are known to vary and are not looked at further."""
    out = []
    for i, x in enumerate(text.split("\n"), 1):
        if x and not x.isspace():
            long = lengths is not None and x.count(" ") >= ENDS and (n := len(x.split())) > ENDS and n not in lengths
            out.append((i, _VARIES if long and "|" not in x and "·" not in x and "•" not in x and "  " not in x and "\t" not in x else lines.leaves(x)))
    return out


def terms(s: str | None) -> frozenset[str]:
    if not s:
        return frozenset()
    s = s.lower()
    if not s.isascii():
        for a, b in _FOLD:
            s = s.replace(a, b)
    return frozenset(_TERM.findall(s))


def own_title(title: frozenset[str], split: Sequence[str], nodes: Page) -> int | None:
    """Place among the nodes of the first line that agrees with the record's title: more than half of their terms are common."""
    if not title:
        return None
    most = 4 * len(title) + 8  # a line of more words than that would have more terms than can agree, or mostly none
    for k, (i, leaves) in enumerate(nodes):
        line = split[i - 1]
        if leaves[0][0] == "i" or line.count(" ") > most:
            continue
        t = terms(line)
        if 2 * len(t & title) > len(t | title):
            return k
    return None


def simple_tree_matching(a: Page, b: Page) -> list[str]:
    """The leaves that a heaviest order-preserving matching of two pages' lines finds in both."""
    common = {leaf for _, x in a for leaf in x} & {leaf for _, y in b for leaf in y}
    # lines without a common leaf match nothing: the programme runs over the others only
    xs, ys = [x for _, x in a if any(f in common for f in x)], [y for _, y in b if any(f in common for f in y)]
    n, m = len(xs), len(ys)
    best = [[0] * (m + 1)]
    where: dict[str, set[int]] = {}
    for j, y in enumerate(ys):
        for f in y:
            where.setdefault(f, set()).add(j)
    weights = []
    for x in xs:
        row: dict[int, int] = {}
        for f in x:
            for j in where.get(f, ()):
                row[j] = row.get(j, 1) + 1  # the node itself and its matched children
        weights.append(row)
    for i in range(n):
        above, row, w = best[-1], [0] * (m + 1), weights[i]
        left = 0
        for j in range(m):
            v = above[j + 1]
            if left > v:
                v = left
            g = w.get(j)
            if g is not None and above[j] + g > v:
                v = above[j] + g
            row[j + 1] = left = v
        best.append(row)
    out: list[str] = []
    i, j = n, m
    while i and j:
        g = weights[i - 1].get(j - 1)
        if g is not None and best[i][j] == best[i - 1][j - 1] + g:
            out += set(xs[i - 1]) & set(ys[j - 1])
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return out


VOTES = "leaf string, votes bigint, seen bigint, titled bigint, above bigint, below bigint, own bigint, heads bigint"


def induce(records: Iterable[tuple[str | None, frozenset[str], str]], lines: Lines) -> list[tuple[str, int, int, int, int, int, int, int]]:
    """Rows of ``VOTES`` over the pages of one shard, given as (title, terms of the record, text) of distinct texts: how often a leaf was
    matched on two pages, seen, seen on a page with a title, before that title, after the last varying node, as the own title,
    and before titles of other adverts."""
    records = sorted(records, key=lambda r: r[2])
    pages = [page(text, lines) for _, _, text in records]
    on: Counter[str] = Counter(f for p in pages for f in {f for _, leaves in p for f in leaves})
    code = {f: zlib.crc32(f.encode()) for f, n in on.items() if n > 1}  # leaves of one page match nothing
    shared = [[(i, kept) for i, leaves in p if (kept := tuple([f for f in leaves if f in code]))] for p in pages]
    whole: list[set[str]] = []
    keys: list[tuple] = []
    for p, s in zip(pages, shared):
        whole.append({leaves[0] for _, leaves in p if leaves[0][0] == "s"})
        own_leaves = {f for _, leaves in s for f in leaves}
        codes = [code[f] for f in own_leaves if f[0] in "siw"]
        keys.append((min([(on[f], code[f]) for f in own_leaves], default=(0, 0)), *[min([c * odd & 0xFFFFFFFF for c in codes], default=0) for odd in ORDERS]))
    votes: Counter[str] = Counter()
    for k in range(1 + len(ORDERS)):  # neighbours in an order share a node
        order = sorted(range(len(pages)), key=lambda i: keys[i][k])
        for x, y in zip(order, order[1:]):
            if 2 * len(whole[x] & whole[y]) <= max(1, len(whole[x]), len(whole[y])):  # the same advert again tells nothing
                votes.update(set(simple_tree_matching(shared[x], shared[y])))
    splits = [text.split("\n") for _, _, text in records]
    at = [own_title(terms(title), split, p) for (title, _, _), split, p in zip(records, splits, pages)]
    titles = {f for p, k in zip(pages, at) if k is not None for f in p[k][1] if f[0] in "sw"}
    constant = titles | {f for f in votes if f[0] not in "be"}
    out: dict[str, list[int]] = {f: [0] * 6 for f in code}
    for (_, words, _), split, p, own in zip(records, splits, pages, at):
        foreign = [k != own and not titles.isdisjoint(leaves) for k, (_, leaves) in enumerate(p)]
        vary = [k for k, (_, leaves) in enumerate(p) if k == own or constant.isdisjoint(leaves)]
        last = vary[-1] if vary else -1
        before = max([k for k in vary if k < own], default=-1) if own is not None else -1
        for k, (i, leaves) in enumerate(p):
            counted = [out[f] for f in leaves if f in out]
            if not counted:
                continue
            if k == own:
                for e in counted:
                    e[4] += 1
                continue
            above = own is not None and before < k < own
            below = k > last and words.isdisjoint(terms(_SLOT.sub(" ", split[i - 1])))
            head = k + 2 < len(p) and foreign[k + 1] and foreign[k + 2] and not foreign[k]
            for e in counted:
                e[0] += 1
                e[1] += own is not None
                e[2] += above
                e[3] += below
                e[5] += head
    return [(f, votes[f], *e) for f, e in out.items()]


def hosted(postings: DataFrame, shard: int = SHARD) -> DataFrame:
    """The pages with host and shard: large hosts are cut into shards of about ``shard`` pages."""
    docs = postings.select("jobid", "jobtitle", "companyname", "joblocation", "jobdescription", F.coalesce(site_host("companyurl"), F.lit("")).alias("host")).filter("jobdescription <> ''")
    sizes = materialize(docs.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "hosts")
    sized = semi_or_salted(docs, sizes, ["host"], how="inner", salt_by=F.xxhash64("jobid"))
    total = max(1, int(sizes.filter(F.col("n") < FEW).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]))
    small = F.col("n") < FEW
    parts = F.when(small, F.lit(-(-total // shard))).otherwise(F.ceil(F.col("n") / shard))
    words = F.concat_ws(" ", "jobtitle", "companyname", "joblocation", F.regexp_extract("host", r"([^.]+)\.[^.]+$", 1))
    return sized.select("jobid", "jobtitle", words.alias("words"), "jobdescription", F.when(small, F.lit("*")).otherwise(F.col("host")).alias("host"), F.pmod(F.xxhash64("jobid", F.lit("shard")), parts).alias("shard"))


def _ratio(n: Column, of: Column, rates: tuple[float, float]) -> Column:
    """Logarithm of how much likelier ``n`` of ``of`` is with the first rate than with the second."""
    p, q = rates
    return n * math.log(p / q) + (of - n) * math.log((1 - p) / (1 - q))


def _score() -> Column:
    """The greater of the two ratios: furniture stands in one place or the other."""
    return F.greatest(_ratio(F.col("above"), F.col("titled"), ABOVE), _ratio(F.col("below"), F.col("seen"), BELOW))


TEMPLATE = "host string, leaf string, score double, title boolean, head boolean"


def template(postings: DataFrame, shard: int = SHARD, min_votes: int = MIN_VOTES) -> DataFrame:
    """Rows of ``TEMPLATE``: the template leaves of all hosts (``host`` null) and those that one host uses in another role."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        texts = {d: (t, terms(w), d) for t, w, d in zip(pdf["jobtitle"], pdf["words"], pdf["jobdescription"])}
        rows = [(key[0], *r) for r in induce(texts.values(), _lines())]
        return pd.DataFrame(rows, columns=["host", *[c.split()[0] for c in VOTES.split(", ")]])

    counts = [c.split()[0] for c in VOTES.split(", ")[1:]]
    pages = hosted(postings, shard).select("host", "shard", "jobtitle", "words", "jobdescription")
    votes = pages.groupBy("host", "shard").applyInPandas(run, "host string, " + VOTES)
    of_host = materialize(votes.groupBy("host", "leaf").agg(*[F.sum(c).alias(c) for c in counts]), "votes")
    every = of_host.groupBy("leaf").agg(*[F.sum(c).alias(c) for c in counts]).filter(F.col("votes") >= min_votes)
    title, head = F.col("leaf").rlike("^[sw]:") & (F.col("own") >= 2), F.col("leaf").rlike("^[swi]:") & (F.col("heads") >= 2) & (5 * F.col("heads") > F.col("seen"))
    every = materialize(every.select(F.lit(None).cast("string").alias("host"), "leaf", _score().alias("score"), title.alias("title"), head.alias("head")), "template")
    own = of_host.filter((F.col("host") != "*") & (F.col("votes") >= min_votes)).select("host", "leaf", _score().alias("own")).filter(F.abs("own") >= OWN)
    other = own.join(every.drop("host"), "leaf").filter((F.col("own") >= DECIDED) != (F.col("score") >= DECIDED))
    return every.unionByName(other.select("host", "leaf", F.col("own").alias("score"), "title", "head"))


_LINES: list[Lines] = []


def _lines() -> Lines:
    """One memory of lines per Python worker."""
    if not _LINES:
        _LINES.append(Lines())
    return _LINES[0]


class Template:
    """The template's leaves as one task needs them: scores, leaves of titles and of heads of lists, lengths in words of whole wordings."""

    def __init__(self, rows: Iterable[tuple[str, float, bool, bool]]):
        self.score: dict[str, float] = {}
        self.titles: set[str] = set()
        self.heads: set[str] = set()
        for f, score, title, head in rows:
            self.score[f] = max(-SURE, min(SURE, score))
            if title:
                self.titles.add(f)
            if head:
                self.heads.add(f)
        self.lengths = {int(f.split(":")[1]) for f in self.score if f[0] == "s"}

    def node(self, leaves: Sequence[str]) -> float | None:
        """What the template says of one node; None if no leaf of it is in the template."""
        known = [(f[0], self.score[f]) for f in leaves if f in self.score]
        if not known:
            return None
        kind, score = known[0]
        if (kind == "s" and abs(score) >= 3) or len(known) == 1:
            return score
        of = dict(known)
        return of["w"] if "w" in of else sum([x for _, x in known]) / len(known)


def furniture_of(title: str | None, text: str, told: Template, lines: Lines, words: bool = True) -> list[tuple[int, bool]]:
    """(line number, whether words broke the tie) of the lines of a page that are furniture."""
    nodes, split = page(text, lines, told.lengths), text.split("\n")
    own, out, listed = own_title(terms(title), split, nodes), [], False
    for k, (i, leaves) in enumerate(nodes):
        if k == own:
            listed = False
            continue
        listed = not told.heads.isdisjoint(leaves) or (listed and not told.titles.isdisjoint(leaves))
        score = SURE if listed else told.node(leaves)
        if score is None:
            continue
        tie = score < DECIDED
        if tie and not (words and score > -SURE and lines.roles.furniture(split[i - 1])):
            continue
        if not lines.residue(split[i - 1]):  # a finding of problem 1 is none here
            out.append((i, tie))
    return out


LINES = "jobid bigint, line_no bigint, by_words boolean"


def furniture_lines(postings: DataFrame, leaves: DataFrame | None = None, words: bool = True) -> DataFrame:
    """(jobid, line_no, by_words) of the lines that are template nodes in the role of furniture."""
    leaves = materialize(leaves if leaves is not None else template(postings), "template")
    docs = postings.select("jobid", "jobtitle", F.coalesce(site_host("companyurl"), F.lit("")).alias("host"), "jobdescription").filter("jobdescription <> ''")
    if is_small(leaves, SHIPPED_LEAVES):
        shipped = postings.sparkSession.sparkContext.broadcast([tuple(r) for r in leaves.select("host", "leaf", "score", "title", "head").collect()])

        def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rows = shipped.value
            every = Template(r[1:] for r in rows if r[0] is None)
            hosts = {h: Template([*[r[1:] for r in rows if r[0] is None], *[r[1:] for r in rows if r[0] == h]]) for h in {r[0] for r in rows if r[0] is not None}}
            for b in batches:
                rows = [(j, i, w) for j, t, h, d in zip(b["jobid"], b["jobtitle"], b["host"], b["jobdescription"]) for i, w in furniture_of(t, d, hosts.get(h, every), _lines(), words)]
                yield pd.DataFrame(rows, columns=["jobid", "line_no", "by_words"])

        return docs.mapInPandas(decide, LINES).distinct()

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(j, h, f) for j, h, d in zip(b["jobid"], b["host"], b["jobdescription"]) for f in {f for _, x in page(d, _lines()) for f in x}]
            yield pd.DataFrame(rows, columns=["jobid", "host", "leaf"])

    def decide_told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for j, t, d, told in zip(b["jobid"], b["jobtitle"], b["jobdescription"], b["told"]):
                mine = Template((r["leaf"], r["score"], r["title"], r["head"]) for r in sorted(told if told is not None else [], key=lambda r: r["host"] is not None))
                rows += [(j, i, w) for i, w in furniture_of(t, d, mine, _lines(), words)]
            yield pd.DataFrame(rows, columns=["jobid", "line_no", "by_words"])

    # the leaves of a page meet the template and come back as one row per page, as long as the page
    leaf_rows = docs.mapInPandas(spread, "jobid bigint, host string, leaf string")
    met = semi_or_salted(leaf_rows, leaves.withColumnRenamed("host", "_of"), ["leaf"], how="inner", salt_by=F.xxhash64("jobid")).filter("_of is null or _of = host")
    told = met.groupBy("jobid").agg(F.collect_set(F.struct(F.col("_of").alias("host"), "leaf", "score", "title", "head")).alias("told"))
    return docs.join(told, "jobid").select("jobid", "jobtitle", "jobdescription", "told").mapInPandas(decide_told, LINES).distinct()
