"""Keywords: candidates by a relational YAKE (K2), filters, confidence, dedup, order, top 20.

Order of the steps: top 20 candidates per language and text, then filters, then dedup, then top 20. All windows are by posting,
so the tokens are shuffled once by posting and no posting's keywords are ever one list until the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.functions.text import WORD, col, strip
from postloom.runtime import is_small, materialize

TOP = 20
#: Stop words up to which the list is a literal of the plan.
STOP_LITERAL = 2000
# Names of the sources.
YAKE_SOURCES = ("yake-da", "yake-en")
LEGACY = "legacy"


def confidence(score: Column | str) -> Column:
    """K5: 1 - score within 0 and 1; no score (or none that is a number) gives null."""
    s = F.expr("try_cast(0 as double)") if score is None else col(score).try_cast("double")
    s = F.when(~F.isnan(s), s)
    return F.when(s.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - s)))


def _stops(stops: DataFrame) -> DataFrame:
    words = stops.select(F.lower("word").alias("_stop")).distinct()
    return F.broadcast(words) if is_small(words) else words


def valid(candidates: DataFrame, stops: DataFrame, keyword: str = "keyword", category: str | None = None) -> DataFrame:
    """K4: without keywords that are null, blank, one character, a stop word (or the posting's category), or made of stop
    words only; a keyword without any word stays. The stripped keyword is kept."""
    k = candidates.withColumn(keyword, strip(keyword)).filter(F.length(keyword) > 1)
    if category is not None:
        k = k.filter(~F.coalesce(F.lower(keyword) == F.lower(category), F.lit(False)))
    if is_small(stops, STOP_LITERAL):  # a list of that size is a constant of the plan, and the filter stays in the scan's stage
        listed = F.array(*[F.lit(w) for w in sorted({r[0].lower() for r in stops.select("word").collect()})]).cast("array<string>")
        words = F.regexp_extract_all(F.lower(keyword), F.lit(f"{WORD}+"), F.lit(0))
        return k.filter(~F.array_contains(listed, F.lower(keyword)) & ~((F.size(words) > 0) & F.forall(words, lambda w: F.array_contains(listed, w))))
    words = k.select(F.lower(keyword).alias("_kw")).distinct().withColumn("_w", F.explode(F.array_distinct(F.concat(F.array("_kw"), F.regexp_extract_all("_kw", F.lit(f"{WORD}+"), F.lit(0))))))
    is_word = F.col("_w").rlike(f"^{WORD}+$")
    judged = words.join(_stops(stops), F.col("_w") == F.col("_stop"), "left").groupBy("_kw").agg(
        F.max(((F.col("_w") == F.col("_kw")) & F.col("_stop").isNotNull()).cast("int")).alias("whole"), F.count(F.when(is_word, 1)).alias("words"), F.count(F.when(is_word & F.col("_stop").isNotNull(), 1)).alias("stopped"),
    )
    bad = judged.filter((F.col("whole") == 1) | ((F.col("words") > 0) & (F.col("words") == F.col("stopped")))).select("_kw")
    return k.withColumn("_kw", F.lower(keyword)).join(bad, "_kw", "left_anti").drop("_kw")


def best_per_key(candidates: DataFrame, posting: str, keyword: str, conf: str, order: str) -> DataFrame:
    """K6: one row per posting and lower-case keyword: the highest confidence (null counts as 0), the earlier of ties; ``first_at`` is
    the place of the first row of the key."""
    keyed = candidates.withColumn("_key", F.lower(keyword))  # one column, so that both windows share one shuffle and one sort
    key = Window.partitionBy(posting, "_key")
    ranked = keyed.withColumn("_rank", F.row_number().over(key.orderBy(F.coalesce(F.col(conf), F.lit(0.0)).desc(), F.col(order).asc()))).withColumn("first_at", F.min(order).over(key))
    return ranked.filter("_rank = 1").drop("_rank", "_key")


def top_keywords(deduped: DataFrame, posting: str, conf: str, first_at: str = "first_at", k: int = TOP, category: Column | None = None) -> DataFrame:
    """K7, K8: the k best of a posting by (confidence descending with null last, first place), with ``rank`` from 1. With ``category`` (a flag
    of the category's own keyword) that keyword takes the last place if it would be cut off."""
    order = Window.partitionBy(posting).orderBy(F.coalesce(F.col(conf), F.lit(-1.0)).desc(), F.col(first_at).asc())
    ranked = deduped.withColumn("rank", F.row_number().over(order))
    if category is None:
        return ranked.filter(F.col("rank") <= k)
    of = Window.partitionBy(posting)
    cut = F.max(F.when(category, F.col("rank"))).over(of) > k
    return ranked.withColumn("_c", category).withColumn("_cut", F.coalesce(cut, F.lit(False))).filter((F.col("rank") <= F.lit(k) - F.col("_cut").cast("int")) | (F.col("_cut") & F.col("_c"))).withColumn(
        "rank", F.least("rank", F.lit(k))
    ).drop("_c", "_cut")


def display(top: DataFrame, posting: str, keyword: str) -> DataFrame:
    """K9: (posting, keywords, display): at most 20 keywords in order."""
    lists = top.groupBy(posting).agg(F.sort_array(F.collect_list(F.struct("rank", F.col(keyword).alias("keyword")))).alias("_k"))
    words = F.transform("_k", lambda x: x["keyword"])
    return lists.select(posting, words.alias("keywords"), F.array_join(words, ", ").alias("display"))


def keyword_rows(detailed: DataFrame, posting: str, keywords: str) -> DataFrame:
    """An array of (keyword, source, confidence) as rows."""
    return detailed.select(posting, F.explode(keywords).alias("_k")).select(posting, "_k.keyword", "_k.source", F.col("_k.confidence").alias("confidencescore"))


def legacy_rows(postings: DataFrame, posting: str, keywords: str) -> DataFrame:
    """A comma-separated string as rows of source ``legacy`` without a score; blanks are dropped."""
    words = F.filter(F.transform(F.split(F.coalesce(F.col(keywords), F.lit("")), ","), lambda w: F.trim(w)), lambda w: w != "")
    return postings.select(posting, F.explode(words).alias("keyword")).select(posting, "keyword", F.lit(LEGACY).alias("source"), F.lit(None).cast("double").alias("confidencescore"))


TOKEN = r"[\p{L}\p{N}_]+(?:[-'’][\p{L}\p{N}_]+)*"


def tokens(texts: DataFrame, posting: str, text: str) -> DataFrame:
    """(posting, sentence, at, word, left, right) of every word with its lower-case neighbours; sentences end at . ! ? and new
    lines. The texts are shuffled once by posting; everything that is computed by posting afterwards stays where it is."""
    sents = texts.select(posting, F.col(text).alias("_t")).repartition(posting).select(posting, F.posexplode(F.regexp_extract_all("_t", F.lit(r"[^.!?\n]+"), F.lit(0))).alias("sentence", "_s"))
    words = sents.select(posting, "sentence", F.regexp_extract_all("_s", F.lit(TOKEN), F.lit(0)).alias("_w"))
    near = F.transform("_w", lambda w, i: F.struct(w.alias("word"), F.lower(F.get("_w", i - 1)).alias("left"), F.lower(F.get("_w", i + 1)).alias("right")))
    return words.select(posting, "sentence", F.posexplode(near).alias("at", "_n")).select(posting, "sentence", "at", "_n.word", "_n.left", "_n.right")


def yake_scores(texts: DataFrame, posting: str, text: str, stops: dict[str, DataFrame]) -> DataFrame:
    """K2: (posting, source, term, keyword, first_at, score) of one-word candidates after Campos et al. (2020): casing, position,
    frequency, relatedness and spread over sentences; lower is better. ``stops``: the stop list of each source. Stop words,
    numbers and one-letter words are no candidates. Follows the paper, not the library's digits.

    All sources share one pass: a text's words meet in one aggregation per term (the sets of neighbours are bounded by the text)
    and one window by posting, without a further shuffle."""
    words = tokens(texts, posting, text).withColumn("term", F.lower("word"))
    upper = F.col("word").rlike(r"^\p{Lu}") & (F.col("at") > 0)
    acronym = F.col("word").rlike(r"^\p{Lu}{2,}$")
    stats = words.groupBy(posting, "term").agg(
        F.count(F.lit(1)).alias("tf"), F.sum(upper.cast("int")).alias("tf_upper"), F.sum(acronym.cast("int")).alias("tf_acronym"), F.median("sentence").alias("mid"), F.size(F.collect_set("sentence")).alias("sf"),
        F.size(F.collect_set("left")).alias("dl"), F.count("left").alias("nl"), F.size(F.collect_set("right")).alias("dr"), F.count("right").alias("nr"), F.min(F.struct("sentence", "at", "word")).alias("first"),
        F.max("sentence").alias("ls"),
    )
    of = Window.partitionBy(posting)
    word = (F.length("term") > 1) & ~F.col("term").rlike(r"^[\p{N}_\-]+$")
    over: dict[str, Column] = {"max_tf": F.max("tf").over(of), "n_sents": F.max("ls").over(of) + 1}
    for n, own in enumerate(stops.values()):
        stats = stats.join(_stops(own).withColumn(f"stop{n}", F.lit(True)), F.col("term") == F.col("_stop"), "left").drop("_stop")
        tf = F.when(F.col(f"stop{n}").isNull() & word, F.col("tf"))
        over |= {f"good{n}": F.col(f"stop{n}").isNull() & word, f"mean{n}": F.avg(tf).over(of), f"sd{n}": F.coalesce(F.stddev_pop(tf).over(of), F.lit(0.0))}
    stats = stats.withColumns(over)
    case = F.greatest("tf_upper", "tf_acronym") / (1 + F.log("tf"))
    pos = F.log(F.log(3 + F.col("mid")))
    share = F.when(F.col("nl") > 0, F.col("dl") / F.col("nl")).otherwise(0.0) + F.when(F.col("nr") > 0, F.col("dr") / F.col("nr")).otherwise(0.0)
    rel = 1 + share * F.col("tf") / F.col("max_tf")
    spread = F.col("sf") / F.col("n_sents")
    each = []
    for n, source in enumerate(stops):
        norm = F.col("tf") / (F.col(f"mean{n}") + F.col(f"sd{n}"))
        s = rel * pos / (case + norm / rel + spread / rel)
        each.append(F.when(F.col(f"good{n}"), F.struct(F.lit(source).alias("source"), (s / (F.col("tf") * (1 + s))).alias("score"))))
    scored = stats.withColumn("_e", F.explode(F.array_compact(F.array(*each))))
    return scored.select(posting, "_e.source", "term", F.col("first.word").alias("keyword"), (F.col("first.sentence") * 100_000 + F.col("first.at")).cast("bigint").alias("first_at"), "_e.score")


def yake_top(scored: DataFrame, posting: str, k: int = TOP) -> DataFrame:
    """The k best candidates of each posting and source, with ``idx`` from 1 within the source."""
    order = Window.partitionBy(posting, "source").orderBy(F.round("score", 9).asc(), F.col("term").asc())
    return scored.withColumn("idx", F.row_number().over(order)).filter(F.col("idx") <= k)


def keywords_of(texts: DataFrame, posting: str, text: str, stops: dict[str, DataFrame], filter_stops: DataFrame, category: str | None = None) -> DataFrame:
    """K2-K8 end to end: candidates of each source in turn, filters, confidence, dedup, top 20. ``stops``: the extractor's own
    stop list of each source; ``filter_stops``: those applied afterwards."""
    out = yake_top(yake_scores(texts, posting, text, stops), posting).select(posting, "keyword", "source", "score", "idx")
    turn = F.element_at(F.create_map(*[F.lit(x) for n, source in enumerate(stops) for x in (source, n * TOP)]), F.col("source"))
    out = out.withColumn("idx", F.col("idx") + turn)
    if category is not None:
        out = out.join(texts.select(posting, F.col(category).alias("_category")), posting)
    out = materialize(out, "candidates")  # read twice below
    kept = valid(out, filter_stops, "keyword", "_category" if category else None).withColumn("confidence", F.round(confidence("score"), 9))  # digits that differ by the order of sums decide nothing
    return top_keywords(best_per_key(kept, posting, "keyword", "confidence", "idx"), posting, "confidence").select(posting, "rank", "keyword", "source", F.round("confidence", 6).alias("confidence"))
