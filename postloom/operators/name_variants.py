"""Problem 4: link the spellings that mean the same organisation.

Distinct names are taken apart (legal form, department, branch, trade, core, acronym). The cores are
blocked by the suffixes of their tokens from three letters on (two in short tokens), and of their tokens read backwards, so that an error near the end
leaves a suffix too. Of the nested suffixes of a token the shortest one with at most ``COMMON`` cores makes its block.
Where two cores share none but over-common suffixes these are not discarded: their cores are blocked by the field beside the
suffix, the rest of the name, with a letter left out: two cores that are one edit or one moved letter apart
share the longer one less a letter, so every pair that the comparison accepts shares a key, however common
their beginnings and endings are. (Trade and address cannot take that part: they are missing or differ in many spellings.) Pairs within a block are
compared by the ratio of their longest common subsequence. Linked cores form components by label propagation over tables in
the shared folder. An organisation is a component and a trade; a name without a trade joins the only trade
of its core or the one its addresses point to, an acronym the organisation that writes it in brackets or
whose address its postings bear.

Only distinct names are compared, so a name on a third of the rows is one item. The result has one row per
pair of spellings because TESTDATA.md asks for pairs.

Defined results: null and blank names are no spelling; names equal after removal of outer white space are
one spelling; a name with no core is linked only as an acronym; an empty table gives no pairs.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions.text import site_host, strip
from postloom.runtime import materialize, semi_or_salted

#: Cores that may share a suffix and still be a block.
COMMON = 30
#: Least LCS ratio of two cores: one edit in seven letters or more, or a swap of neighbours.
LEAST_RATIO = 0.85

# Legal forms, trades with their English names, words of departments.
LEGAL = {"a/s", "as", "a.s.", "a.s", "aps", "aps.", "i/s", "is", "p/s", "k/s", "ivs", "amba", "gmbh", "ab", "asa", "ltd", "inc", "aktieselskab", "aktieselskabet", "anpartsselskab", "anpartsselskabet", "interessentskab", "interessentskabet"}
TRADES = {
    "apotek": "pharmacy", "bryghus": "brewery", "ejendomme": "properties", "elektronik": "electronics", "energi": "energy", "entreprise": "contracting", "forsikring": "insurance", "fødevarer": "foods",
    "gartneri": "nurseries", "kommune": "municipality", "logistik": "logistics", "maskinfabrik": "machine works", "møbler": "furniture", "rengøring": "cleaning", "revision": "audit", "rådgivning": "advisory",
    "skibsværft": "shipyard", "tandklinik": "dental", "teknik": "engineering", "transport": "haulage", "trykkeri": "printing", "tømrerforretning": "carpentry", "vikarbureau": "staffing", "bageri": "bakery",
    "hotel": "hotel", "skole": "school", "sygehus": "hospital", "bank": "bank", "restaurant": "restaurant", "rederi": "shipping", "auto": "motors", "byg": "construction",
}
SHORT = {"apt": "apotek", "ejd": "ejendomme", "kom": "kommune", "en": "energi", "fors": "forsikring"}
INFLECTED = {"kommunen": "kommune"}


def fold(s: str) -> str:
    s = unicodedata.normalize("NFC", s).casefold()
    for a, b in (("æ", "ae"), ("ø", "oe"), ("å", "aa"), ("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("é", "e")):
        s = s.replace(a, b)
    return s


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over the letters of ``a``."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & at.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


_DANISH = {fold(t): t for t in TRADES} | {re.sub("oe", "o", re.sub("ae", "a", re.sub("aa", "a", fold(t)))): t for t in TRADES}
_ENGLISH = {e: t for t, e in TRADES.items()} | {"machine": "maskinfabrik"}


def trade_of(token: str, alone: bool = False) -> str | None:
    """The trade that one token means: exact, English, abbreviated with or without a stop, or mistyped."""
    dotted = token.endswith(".")
    t = fold(token.strip(".,"))
    if t in INFLECTED:
        return INFLECTED[t]
    if t in _DANISH:
        return _DANISH[t]
    if t in _ENGLISH:
        return _ENGLISH[t]
    if dotted and t in SHORT:
        return SHORT[t]
    if len(t) >= (2 if dotted else 3):
        starts = sorted({_DANISH[d] for d in _DANISH if d.startswith(t)})
        if len(starts) == 1:
            return starts[0]
        if starts and not dotted:
            return min(starts, key=len)
    if len(t) >= 5:
        best = max(_DANISH, key=lambda d: (ratio(t, d), d))
        if ratio(t, best) >= 0.8 and abs(len(t) - len(best)) <= 2 and t[0] == best[0] or ratio(t, best) >= 0.88:
            return _DANISH[best]
    return None


def parse(name: str) -> tuple[str, str | None, str | None, bool]:
    """(core, trade, acronym, legal) of a name."""
    s = unicodedata.normalize("NFC", name)
    s = re.sub(r"\s+", " ", s).strip()
    acronym = None
    if re.fullmatch(r"[A-ZÆØÅÄÖ]{2,5}", s):
        return "", None, s, False
    m = re.search(r"\(([A-ZÆØÅÄÖ]{2,5})\)", s)
    if m:
        acronym = m.group(1)
    s = re.sub(r"\([^)]*\)", " ", s)
    s = re.sub(r"\s*(?:&|\+|\bog\b|\band\b)\s*co\b\.?", " ", s, flags=re.I)
    by = re.fullmatch(r"(.+?) by (.+)", s.strip(), re.I)
    if by and trade_of(by.group(1).split()[0]) and fold(by.group(1)) in _ENGLISH:
        s = f"{by.group(2)} {by.group(1)}"
    parts = []
    for part in re.split(r",| - | – | \| ", s):
        core, trade, legal = [], None, False
        tokens = [t for t in re.split(r"\s+|(?<=\w)-(?=\w)", part.strip()) if t]
        if tokens and fold(tokens[0]) in ("hr", "afdeling", "afd", "afd."):
            continue  # a department
        joined = fold(" ".join(tokens))
        for e, t in _ENGLISH.items():
            if " " in e and e in joined:
                trade = t
                tokens = [x for x in tokens if fold(x) not in e.split()]
        for t in tokens:
            if fold(t) in LEGAL:
                legal = True
                continue
            found = trade_of(t) if trade is None else None
            if found:
                trade = found
            else:
                core.append(fold(t).strip(".,"))
        core = [c for c in core if c]
        if trade is None and len(core) == 1 and core[0].endswith("kommune") and len(core[0]) > 10:
            core, trade = [core[0][: -len("kommune")]], "kommune"
        if core or trade:
            parts.append((core, trade, legal))
    if not parts:
        return "", None, acronym, False
    whole = [p for p in parts if p[0] and p[1]]
    if whole:
        core, trade, legal = whole[0]
    else:
        heads, trades = [p for p in parts if p[0]], [p for p in parts if p[1]]
        core = heads[0][0] if heads else []
        trade = trades[0][1] if trades else None
        legal = any(p[2] for p in parts)
    return " ".join(core), trade, acronym, legal


@F.pandas_udf(T.StructType([T.StructField(x, T.StringType()) for x in ("core", "trade", "acronym")]))
def parsed(names: pd.Series) -> pd.DataFrame:
    rows = [parse(n)[:3] for n in names]
    return pd.DataFrame(rows, columns=["core", "trade", "acronym"])


@F.pandas_udf(T.BooleanType())
def similar(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether two cores are spellings of one: high LCS ratio, or one is the other cut short."""
    return pd.Series([_similar(x, y) for x, y in zip(a, b)], dtype=bool)


def _plain(s: str) -> str:
    return s.replace("ae", "a").replace("oe", "o").replace("aa", "a")


def _similar(x: str, y: str) -> bool:
    if x.split() and x.split()[0] != y.split()[0] and (" " in x or " " in y) and x.split()[-1] == y.split()[-1]:
        return False  # "nørre x" and "x" are different places
    short, long = sorted((_plain(x), _plain(y)), key=len)
    return len(long) - len(short) <= 1 and lcs(short, long) >= len(long) - 1 and ratio(short, long) >= LEAST_RATIO


def slug(url):
    """What an address says about the employer: the last part of a company page, else the first label of an own
    host without the words for career pages and legal forms."""
    page = F.regexp_extract(url, r"(?i)/(?:virksomhed|company|firma)/(?:\d+/)?([^/?#]+)", 1)
    own = F.regexp_replace(F.regexp_extract(site_host(url), r"^(?:karriere\.|career\.|jobs?\.)?([^.]+)", 1), r"-(?:a-s|aps|i-s)$", "")
    return F.lower(F.when(page != "", page).otherwise(F.when(own != "", own)))


def components(edges: DataFrame, nodes: DataFrame, rounds: int = 30) -> DataFrame:
    """(node, root): the smallest node of each connected component, by min-label propagation with pointer
    jumping; every round is a table in the shared folder. ``edges``: a, b."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    label = materialize(nodes.select(F.col("node"), F.col("node").alias("root")), "labels")
    for _ in range(rounds):
        near = both.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        low = label.join(near, "node", "left").select("node", F.least("root", F.coalesce("near", "root")).alias("low"), F.col("root").alias("old"))
        jump = low.join(low.select(F.col("node").alias("low"), F.col("low").alias("lower")), "low", "left")
        label = materialize(jump.select("node", F.least("low", F.coalesce("lower", "low")).alias("root"), "old"), "labels")
        if label.filter("root <> old").isEmpty():
            break
        label = label.select("node", "root")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return label.select("node", "root")


#: Letters from which on two cores of the same length may differ in a letter each (6 of 7 reach LEAST_RATIO, 5 of 6 do not).
BOTH_CUT = 7
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def _hashes(core: str) -> list[int]:
    """Hashes of the plain core and, after it, of the distinct strings that are left when one of its letters is left out."""
    s = _plain(core)
    heads, tails, power = [0], [0], [1]
    for c in s:
        heads.append((heads[-1] * _BASE + ord(c)) % _PRIME)
    for c in reversed(s):
        tails.append((tails[-1] + ord(c) * power[-1]) % _PRIME)
        power.append(power[-1] * _BASE % _PRIME)
    n = len(s)
    # leaving out either of two equal neighbours gives the same
    return [heads[n], *((heads[i] * power[n - 1 - i] + tails[n - 1 - i]) % _PRIME for i in range(n) if i == 0 or s[i] != s[i - 1])]


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("key", T.LongType()), T.StructField("cut", T.BooleanType()), T.StructField("letters", T.IntegerType())])))
def keys_of(cores: pd.Series) -> pd.Series:
    return pd.Series([[(h, k > 0, len(_plain(c))) for k, h in enumerate(_hashes(c))] for c in cores])


def suffixes(cores: DataFrame) -> DataFrame:
    """(core, at, back, short, first, key): the suffixes of every token of distinct cores, and of the token read backwards. Those of one and two letters, of
    short tokens only, are a chain of their own, so that the chains of two tokens begin alike; ``first`` marks the beginning of a chain."""
    plain = F.col("core")
    for a, b in (("ae", "a"), ("oe", "o"), ("aa", "a")):
        plain = F.replace(plain, F.lit(a), F.lit(b))
    tokens = cores.select("core", F.posexplode(F.filter(F.split(plain, " "), lambda t: t != "")).alias("at", "t"))
    n = F.length("t")
    sized = tokens.withColumn("k", F.explode(F.sequence(F.when(n <= 5, F.least(n, F.lit(2))).otherwise(3), n))).withColumns({"short": F.col("k") < 3, "first": F.col("k") <= 3})
    ends = F.array(F.struct(F.lit(False).alias("back"), F.concat(F.lit("-"), F.right("t", "k")).alias("key")), F.struct(F.lit(True).alias("back"), F.concat(F.left("t", "k"), F.lit("-")).alias("key")))
    return sized.select("core", "at", "k", "short", "first", F.explode(ends).alias("e")).select("core", "at", "e.back", "k", "short", "first", "e.key")


def candidate_pairs(cores: DataFrame, common: int = COMMON) -> DataFrame:
    """Pairs (a, b), a < b, of cores that share a block: all pairs of a common suffix that :func:`similar` accepts and few others. ``cores``: core."""
    distinct = cores.select("core").distinct()
    rows = materialize(suffixes(distinct), "suffixes")
    crowded = materialize(rows.select("key", "core").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > common), "crowded")
    told = semi_or_salted(rows, crowded, ["key"], how="left", salt_by=F.xxhash64("core"))
    block = materialize(told.filter("held is null").groupBy("core", "at", "back", "short").agg(F.min_by("key", "k").alias("key")).select("core", "key").distinct(), "blocks")
    a, b = block.select("key", F.col("core").alias("a")), block.select("key", F.col("core").alias("b"))
    near = F.abs(F.length("a") - F.length("b")) <= 3  # letters that are written as two count as one in the comparison
    pairs = a.join(b, "key").filter(F.col("a") < F.col("b")).filter(near).select("a", "b")  # at most common cores a block
    rest = told.filter("held is not null and first").select("core").distinct()
    return pairs.unionByName(refined_pairs(rest)).distinct()


def refined_pairs(cores: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of distinct cores that are equal when a letter is left out. A block has at most the cores that one more letter can
    make of its key: letters of the alphabet times places."""
    index = cores.select("core", F.explode(keys_of("core")).alias("k")).select("core", "k.key", "k.cut", "k.letters")
    a, b = index.select("key", F.col("core").alias("a"), F.col("cut").alias("cut_a"), F.col("letters").alias("letters")), index.select("key", F.col("core").alias("b"), F.col("cut").alias("cut_b"))
    met = ~(F.col("cut_a") & F.col("cut_b")) | (F.col("letters") >= BOTH_CUT)
    return a.join(b, "key").filter(F.col("a") < F.col("b")).filter(met).select("a", "b").distinct()


def organisations(postings: DataFrame, name: str = "companyname", url: str = "companyurl") -> DataFrame:
    """(name, org): the organisation of every distinct spelling that could be told."""
    rows = postings.select(strip(name).alias("name"), slug(F.col(url)).alias("slug")).filter("name <> ''")
    seen = rows.groupBy("name", "slug").agg(F.count(F.lit(1)).alias("n"))
    best = seen.groupBy("name").agg(
        F.max_by("slug", F.when(F.col("slug").isNotNull(), F.struct("n", "slug"))).alias("slug"),
        F.max(F.when(F.col("slug").isNotNull(), F.col("n"))).alias("top"), F.sum(F.when(F.col("slug").isNotNull(), F.col("n"))).alias("told"), F.sum("n").alias("n"),
    )
    names = materialize(best.withColumn("p", parsed("name")).select("name", "slug", "top", "told", "n", F.col("p.core").alias("core"), F.col("p.trade").alias("trade"), F.col("p.acronym").alias("acronym")), "names")

    cores = names.filter("core <> ''").select("core", "trade", "slug").distinct()
    pairs = candidate_pairs(cores).filter(similar("a", "b"))
    # a core that is cut short ("Rosagkla" for "Rosagklafors") is linked to the only longer core that begins so
    full = names.filter("core <> ''").groupBy("core").agg(F.sum("n").alias("n"), F.max_by("slug", F.col("n")).alias("slug"))
    heads = full.select("core", F.explode(F.sequence(F.lit(5), F.greatest(F.lit(5), F.length("core") - 2))).alias("k"), "n", "slug").filter("k < length(core)").select(F.left("core", "k").alias("short"), F.col("core").alias("long"), "n", "slug")
    cut = heads.join(full.select(F.col("core").alias("short"), F.col("slug").alias("short_slug")), "short")
    agrees = F.coalesce(F.col("slug") == F.col("short_slug"), F.lit(False)).cast("int")
    cut = cut.groupBy("short").agg(F.max_by("long", F.struct(agrees, "n", "long")).alias("long")).select(F.least("short", "long").alias("a"), F.greatest("short", "long").alias("b"))
    roots = components(pairs.select("a", "b").union(cut), full.select(F.col("core").alias("node")))

    known = materialize(names.join(roots.withColumnRenamed("node", "core"), "core", "left"), "rooted")
    trades = known.filter("root is not null and trade is not null").groupBy("root").agg(F.collect_set("trade").alias("trades"))  # at most as many as there are trades
    only = trades.filter(F.size("trades") == 1).select("root", F.col("trades")[0].alias("only"))
    by_slug = (
        known.filter("root is not null and trade is not null and slug is not null").groupBy("slug", "root", "trade").agg(F.sum("n").alias("n"))
        .withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("slug"))).filter("share >= 0.8").select("slug", F.col("root").alias("s_root"), F.col("trade").alias("s_trade"))
    )
    told = known.filter("root is not null").join(only, "root", "left").join(by_slug.filter("s_root is not null"), "slug", "left")
    told = told.withColumn("t", F.coalesce("trade", "only", F.when(F.col("s_root") == F.col("root"), F.col("s_trade"))))
    orgs = told.filter("t is not null or only is null").select("name", "acronym", "slug", F.when(F.col("t").isNotNull(), F.concat_ws("\u0001", "root", "t")).otherwise(F.concat_ws("\u0001", "root", F.lit("?"), "name")).alias("org"), "n")
    orgs = materialize(orgs, "orgs")
    # acronyms: the one organisation that writes it in brackets, else the one that the addresses name
    written = orgs.filter("acronym is not null").groupBy("acronym").agg(F.collect_set("org").alias("o")).filter(F.size("o") == 1).select("acronym", F.col("o")[0].alias("w_org"))
    of_slug = (
        orgs.filter("slug is not null").groupBy("slug", "org").agg(F.sum("n").alias("n")).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("slug")))
        .filter("share >= 0.8").select("slug", F.col("org").alias("s_org"))
    )
    bare = names.filter("core = '' and acronym is not null").select("name", "acronym", F.when(F.col("top") >= 0.7 * F.col("told"), F.col("slug")).alias("slug"))
    bare = bare.join(of_slug, "slug", "left").join(written, "acronym", "left").select("name", F.coalesce("w_org", "s_org").alias("org")).filter("org is not null")
    return orgs.select("name", "org").unionByName(bare)


def variant_pairs(postings: DataFrame, name: str = "companyname", url: str = "companyurl") -> DataFrame:
    """(name_a, name_b), name_a < name_b by code points: spellings of one organisation."""
    orgs = materialize(organisations(postings, name, url), "organisations")
    a, b = orgs.select("org", F.col("name").alias("name_a")), orgs.select("org", F.col("name").alias("name_b"))
    return a.join(b, "org").filter("name_a < name_b").select("name_a", "name_b").distinct()


