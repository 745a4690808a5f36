"""Problem 1: template residue, filler, error pages and notices that scripts are needed.

Detectors read every line of a description: placeholders of template languages and fill-in notes,
filler text, error messages and codes, and script notices. A line that one of them knows is residue wherever it stands. Beside them
stands the evidence of address, title, body and host, for whole bodies that no detector knows: the
terms of the address slug and of the title are compared with all those of the body; a body of few different terms is low in information and
counted over distinct titles per host and over all hosts (digits masked). Short adverts look the same in all of that,
so the wording is weighed too: the terms of the low bodies that a detector knows against those of the adverts that agree with their title, by document
counts over the whole collection. A body is flagged if it is low in information, shares no term with title and slug, comes back under several titles
and is worded as the known messages are.

The detectors run in Arrow batches behind an Aho-Corasick automaton of their words, which costs a fraction of as many searches per
text; everything else is column expressions. Only low bodies (a key of 16 bytes) and term counts are shuffled, pre-aggregated.

Defined results: null, empty and blank descriptions are no case; null titles and addresses give no mismatch
evidence; repeated rows are judged alike; with fewer than ``MIN_KNOWN`` known messages there is nothing to compare a wording with; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions.text import NOT_BLANK, site_host, strip
from postloom.runtime import is_small, materialize, semi_or_salted

# Words that fields and fill-in notes of templates are named by (Danish, English, Norwegian, Swedish, German).
FIELD = (
    r"(?:company|virksomhed|firma|foretag|företag|bedrift|unternehmen|arbejdsgiver|employer|job|stilling|stillings|tjänst|stelle|titel|title|tittel|name|navn|namn|dato|date|datum|deadline|frist|ansøgningsfrist|"
    r"startdato|start|location|lokation|sted|ort|by|city|stad|contact|kontakt|person|dept|department|afdeling|avdelning|abteilung|salary|løn|lön|lønn|gehalt|email|e-mail|mail|phone|telefon|tlf|url|link|logo|"
    r"tekst|text|opgaver|opgaverne|tasks|beskrivelse|beskrivning|description|intro|field|felt|body|adresse|address|hr|manager|leder|recruiter)"
)
NOTE = r"(?:skriv|beskriv|indsæt|insert|add|todo|tbd|tba|fixme|udfyld|udfyldes|infoga|ange|fyll|sett inn|einfügen|eintragen|ausfüllen|ergänzen|replace|erstat|slet|enter|type|your|xx+)"
SCRIPT = r"(?:java\s?script|scripts?|scripting|skript\w*|\bjs\b)"

DETECTORS: dict[str, str] = {
    "placeholder": "|".join(
        [
            r"\{\{[^{}\n]{0,80}\}\}", r"\[\[[^\[\]\n]{1,80}\]\]", r"\$\{[^{}\n]{1,60}\}", r"<%[=\-]?[^%\n]{0,80}%>", r"\{%-?[^%\n]{0,80}%\}", r"<!--[^\n]{0,120}?-->", r"<\?(?:php|=)",
            r"##\w{2,40}##", r"@@\w{2,40}@@", r"__[\p{Lu}]{2,}[\p{Lu}_]*__", r"%%\w{2,40}%%", r"%[\p{Lu}]{2,}[\p{Lu}_]*%", r"\{(?:\d{1,2}|[\p{L}]\w{1,40})\}", r"(?<![\w%])%(?:\d\$)?[sd](?![\w%])",
            r"\$[\p{L}_]\w*(?:\.\w+)+", r"\$(?:company|job|title|name|field|dept|location)\w*", r"_{5,}", r"(?<![\p{L}])[Xx]{4,}(?![\p{L}])", r"\[\s*(?:\.{3}|…)\s*\]", r"\bmsg\.key\.\S+|\b\w+(?:\.\w+)*\.not\.found\b",
            r"#(?:VALUE!|REF!|NAME\?|N/A|DIV/0!)", r"\[object \w+\]", r"\bundefined\s+undefined\b|^\s*undefined\s*$", r"\bnull\s*,\s*null\b|^\s*null\s*$", r"\bNaN\b", r"&(?:nbsp|amp);\s*&(?:nbsp|amp);|&amp;amp;",
            r"(?:\[|«|<|&lt;)\s*(?iu:" + NOTE + r")\b[^\]»>\n]{0,60}(?:\]|»|>|&gt;)",
            r"(?:\[|«|<|&lt;)\s*[^\]»>\n|«]{0,40}(?<![\p{L}])(?iu:" + NOTE + r"|her|here)(?:\s+(?iu:by|af|von|av)\s+[^\]»>\n]{1,30})?\s*(?:\]|»|>|&gt;)",
            r"(?:\[|«|<|&lt;)\s*(?iu:" + FIELD + r")(?:[ _\-](?iu:" + FIELD + r"))*\s*(?:\]|»|>|&gt;)",
        ]
    ),
    "filler": "|".join(
        [
            r"(?iu:\blorem\s+ipsum\b|\bdolor\s+sit\s+amet\b|\bconsectetu?(?:er|ur)\b|\bsed do eiusmod\b|\bmollit\s+anim\b|\bvivamus\s+vestibulum\b|\bcurabitur\b|\bnonummy\b|\bexcepteur\s+sint\b)",
            r"(?iu:\basdf\b|\bqwerty\b|\bjklø\b|\bhjkl\b)", r"(?iu:\b(?:dummy|sample|placeholder|filler|eksempel|platshållar|beispiel|blind|brød)[\s-]?(?:tekst|text|copy)\w*\b)",
            r"(?iu:\b(?:tekst|text)\s+(?:mangler|missing|saknas|fehlt|følger|kommer)\b)", r"(?iu:\b(?:delete|remove|slettes?|raderas|löschen)\b[^\n]{0,20}\b(?:before|inden|før|senere|innan|vor)\b)",
            r"(?iu:\b(?:her (?:kommer|skal|kan)|här (?:ska|kommer)|hier (?:kommt|steht|folgt))\b[^\n]{0,30}\b(?:beskrivelse|tekst|texten|text|beskrivning|beschreibung|stå|skrive)\w*)", r"(?iu:\b(?:text|copy) goes here\b)",
            r"(?iu:^\s*skriv noget [\p{L}]+ her\b|\bwrite something\b[^\n]{0,20}\bhere\b)", r"(?iu:\bbitte ersetzen\b)", r"(?iu:\boverskrift \d\b)",
        ]
    ),
    "error": "|".join(
        [
            r"(?iu:\b(?:page|address|document|link|site)\b[^\n.]{0,40}\b(?:could not be (?:found|located)|not found|does not exist|no longer exists|was moved|has gone stale|has expired|is unavailable)\b)",
            r"(?iu:\b(?:could not|cannot|can't|unable to) (?:load|fetch|display|open|find) (?:the|this|that) (?:page|vacancy|document|content|address)\b)", r"(?iu:\bsomething went wrong\b|\baccess denied\b|\btoo many requests\b|\binternal server error\b)",
            r"(?iu:\b(?:service|site|page) (?:is )?temporarily (?:unavailable|closed)\b(?:[^\n]{0,6}\bretry\b|[.,!]))", r"(?iu:\bsession has expired\b|\bsecurity check\b[^\n]{0,20}\bcontinue\b|\bverify (?:your browser|you are (?:a )?human)\b|\byou lack permission\b)",
            r"(?iu:\bthe (?:database|server) (?:did|does) not (?:answer|respond)\b|\bthe connection was (?:reset|closed|lost)\b|\bthe request (?:timed out|took too long|was not completed)\b)", r"(?iu:\bthe incident was logged as\b)",
            r"(?iu:\b(?:siden|dokumentet|adressen|linket|opslaget)\b[^\n.]{0,30}\b(?:blev ikke fundet|findes ikke|er forældet|er flyttet|er slettet|er midlertidigt lukket|kunne ikke findes)\b)",
            r"(?iu:\bnoget gik galt\b|\bnoe gikk galt\b|\bnågot gick (?:snett|fel)\b|\buventet fejl\b|\bunerwarteter fehler\b|\boväntat fel\b|\buventet feil\b)", r"(?iu:\badgang nægtet\b|\bsession er udløbet\b|\bikke (?:er )?en robot\b|\b(?:åtkomst nekad|zugriff verweigert|tilgang nektet)\b)",
            r"(?iu:\b(?:vi )?kan ikke finde det, du leder efter\b|\bfant ikke siden\b|\bkunne ikke hente siden\b|\bsidan kunde inte hittas\b|\bseite (?:wurde )?nicht gefunden\b|\bdu har ikke rettigheder til at se\b)",
            r"(?iu:\b(?:serveren|databasen)\b[^\n.]{0,12}\bsvare(?:r|de) ikke\b|\bforespørgslen tog for lang tid\b|\bforbindelsen blev afbrudt\b|\bhændelsen er logget\b)",
        ]
    ),
    "code": "|".join(
        [
            r"(?iu:\b(?:http|status|error|fejl|fehler|fel|feil|kode|code)\b[\s:#/.]*\(?[45]\d\d\b)", r"(?iu:(?:^|\s)[45]\d\d\s*[-–:!.]?\s*(?:not found|bad gateway|forbidden|gone|internal server|service unavailable|siden?\b))",
            r"(?iu:\((?:kode|fel|feil|fejl|error|code|fehler)?\s*[45]\d\d\)\s*[.!]?\s*(?:$|kontakt))",
        ]
    ),
    "script": "|".join(
        [
            r"(?iu:\b(?:enable|turn on|switch on|activate|aktiver\w*|aktivér|aktivera|aktivieren sie|slå(?: det)?(?: på| til)?|requires?|kræver|kräver|krever|benötigt|erfordert)\b[^\n.]{0,30}" + SCRIPT + r"[^\n]{0,60}\b(?:to (?:run|see|view|use|continue)|for (?:at|å|att)|um\b|browser|app|side|sidan|page|påslag|anzeige|opslag|stilling))",
            r"(?iu:\b(?:page|side|sidan|site|seite|app)\b[^\n.]{0,20}\b(?:requires?|kræver|kräver|krever|benötigt|works only with|needs)\b[^\n.]{0,20}" + SCRIPT + r")",
            r"(?iu:\b(?:browser)\b[^\n.]{0,40}" + SCRIPT + r"|" + SCRIPT + r"[^\n.]{0,24}\b(?:is|are|er|sind|är)?\s?\b(?:disabled|slået fra|slått av|avstängd|deaktiviert|blocked|switched on|slået til|påslagna)\b)",
            r"(?iu:\bturn (?:on|off) (?:scripting|your ad ?blocker)\b|\bad ?blocker\b[^\n]{0,20}\bsee\b)", r"(?iu:^\s*(?:loading|henter(?: opslag)?|indlæser|laddar|laster|wird geladen)\s*(?:\.{3}|…))",
        ]
    ),
}

# What a line must hold before a detector is tried on it (a cheap test that no detector can pass without:
# every alternative holds one of its gates whatever blanks, ends of line or punctuation stand around).
GATES: dict[str, list[str]] = {
    "placeholder": ["{", "[", "«", "<", "&lt;", "$", "#", "_", "@", "%", "&nbsp;", "&amp;", "xxxx", "nan", "null", "undefined", ".not.found", "msg.key"],
    "filler": ["ipsum", "dolor", "consectet", "eiusmod", "mollit", "vivamus", "curabitur", "nonummy", "excepteur", "asdf", "qwerty", "jklø", "hjkl", "tekst", "text", "copy", "delete", "remove", "slette", "raderas", "löschen",
               "her kommer", "her skal", "her kan", "här ska", "här kommer", "hier kommt", "hier steht", "hier folgt", "write something", "skriv noget", "bitte ersetzen", "overskrift "],
    "error": ["not found", "be found", "located", "not exist", "longer exists", "was moved", "gone stale", "has expired", "unavailable", "temporarily", "could not", "cannot ", "can't ", "unable to", "went wrong", "access denied",
              "many requests", "internal server", "session has", "security check", "verify ", "lack permission", "not answer", "not respond", "connection was", "request t", "request was", "logged as", "ikke fundet", "findes ikke",
              "forældet", "er flyttet", "er slettet", "midlertidigt lukket", "kunne ikke", "gik galt", "gikk galt", "gick snett", "gick fel", "uventet fe", "unerwarteter", "oväntat", "adgang nægtet", "er udløbet", "robot", "nekad",
              "verweigert", "nektet", "du leder efter", "fant ikke", "kunde inte", "nicht gefunden", "rettigheder til", "svarer ikke", "svarede ikke", "lang tid", "blev afbrudt", "er logget"],
    "code": ["http", "status", "error", "fejl", "fehler", "fel", "feil", "kode", "code", "not found", "bad gateway", "forbidden", "gone", "internal server", "unavailable", "(", "side"],
    "script": ["script", "js", "skript", "blocker", "loading", "henter", "indlæser", "laddar", "laster", "geladen"],
}
#: A body is low in information with at most so many different terms; it comes back if it has so many titles, or two on one host.
LOW_TERMS, MIN_TITLES, MIN_HOST_TITLES = 14, 3, 2
#: Known messages that are enough to compare with, and the mean log-odds of the terms from which on a body is worded as they are.
MIN_KNOWN, MIN_ODDS = 5, 1.0


def terms(c: Column) -> Column:
    """Distinct lower-case words of three letters and more."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([\p{L}]{3,})"), F.lit(1)))


class Residue:
    """The detectors on texts. One Aho-Corasick pass over the lower-case text finds the gates' words; a detector is tried only on the
    lines that hold one of its words. Lines that were judged are remembered (bounded)."""

    def __init__(self, kinds: tuple[str, ...] = tuple(DETECTORS), limit: int = 200_000):
        import ahocorasick
        import regex

        self.kinds = kinds
        self.words = ahocorasick.Automaton()
        gates: dict[str, list[str]] = {}
        for k in kinds:
            for w in GATES[k]:
                gates.setdefault(w, []).append(k)
        for w, ks in gates.items():
            self.words.add_word(w, (len(w), ks))
        self.words.make_automaton()
        self.patterns = {k: regex.compile("(?m)" + DETECTORS[k]) for k in kinds}
        self.known: dict[tuple[str, str], bool] = {}
        self.limit = limit

    def _judge(self, kind: str, line: str) -> bool:
        out = self.known.get((kind, line))
        if out is None:
            if len(self.known) > self.limit:
                self.known.clear()
            out = self.known[kind, line] = self.patterns[kind].search(line) is not None
        return out

    def __call__(self, text: str) -> tuple[bool, ...]:
        low = text.lower()
        found = dict.fromkeys(self.kinds, False)
        # placeholders are told by letter case; in rare texts lower case has other places, but always the same lines
        lines = text.split("\n") if len(low) != len(text) else None
        start = stop = -1
        tried: set[str] = set()
        for end, (_, kinds) in self.words.iter(low.replace("ſ", "s")):  # patterns take the long s for s
            if end >= stop:
                start, stop = low.rfind("\n", 0, end) + 1, low.find("\n", end)
                stop = len(low) if stop < 0 else stop
                tried = set()
            for k in kinds:
                if not found[k] and k not in tried:
                    tried.add(k)
                    if k != "placeholder":
                        line = low[start:stop]
                    else:
                        line = text[start:stop] if lines is None else lines[low.count("\n", 0, start)]
                    found[k] = self._judge(k, line)
        if "filler" in found and not found["filler"]:
            found["filler"] = repeats(low)
        return tuple(found[k] for k in self.kinds)


def repeats(low: str) -> bool:
    """The same word of two to twelve letters three times in a row."""
    w = low.split()
    return any(2 <= len(a) <= 12 and a.isalpha() for a in [a for a, b, c in zip(w, w[1:], w[2:]) if a == b == c])


class ResidueLines(Residue):
    """Whether a line is residue of one of the kinds (all but placeholders, if none are given)."""

    def __init__(self, kinds: tuple[str, ...] = ("filler", "error", "code", "script")) -> None:
        super().__init__(kinds)
        self.lines: dict[str, bool] = {}

    def __call__(self, line: str) -> bool:  # type: ignore[override]
        out = self.lines.get(line)
        if out is None:
            if len(self.lines) > self.limit:
                self.lines.clear()
            out = self.lines[line] = any(super().__call__(line))
        return out


def detected(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Arrow batches of descriptions to the flags of all detectors."""
    residue = Residue()
    for batch in texts:
        yield pd.DataFrame([residue(t) for t in batch], columns=list(DETECTORS), dtype=bool)


DETECTED = F.pandas_udf(detected, T.StructType([T.StructField(k, T.BooleanType()) for k in DETECTORS]))


def told(postings: DataFrame) -> DataFrame:
    """One row per posting with a description that is not blank: its terms and those of its title and address slug."""
    slug = F.regexp_replace(F.regexp_extract(F.coalesce("joburl", F.lit("")), r"([^/?#]*)(?:[?#].*)?$", 1), r"[-_]", " ")
    out = postings.select(
        "jobid", "jobtitle", site_host("companyurl").alias("site"), "jobdescription", terms(F.col("jobdescription")).alias("words"), F.array_union(terms(F.col("jobtitle")), terms(slug)).alias("told")
    ).filter(F.col("jobdescription").rlike(NOT_BLANK))
    return out


def low() -> Column:
    return F.size("words") <= LOW_TERMS


def agrees() -> Column:
    """Title or slug and body have a term in common."""
    return F.arrays_overlap("told", "words")


def detected_any() -> Column:
    return F.greatest(*[F.col(k).cast("int") for k in DETECTORS]) == 1


def flagged(postings: DataFrame) -> DataFrame:
    """One row per posting with a description that is not blank: the detectors' flags and the row-local evidence; key and terms of
    low bodies only."""
    flags = [F.col(f"_found.{k}").alias(k) for k in DETECTORS]
    out = told(postings).withColumn("_found", DETECTED("jobdescription"))
    return out.select(
        "jobid", "jobtitle", "site", *flags, low().alias("low"), ((F.size("told") > 0) & ~agrees()).alias("mismatch"),
        F.when(low(), F.unhex(F.md5(F.regexp_replace(F.lower(strip("jobdescription")), r"[0-9]+", "0")))).alias("body"), F.when(low(), F.array_sort("words")).alias("words"),
    )


def low_bodies(text: DataFrame) -> DataFrame:
    """One row per low body: its terms, the titles that share it (anywhere, and at most on one host), whether a detector knows it."""
    each = text.filter("low").groupBy("body", F.coalesce("site", F.lit("")).alias("host"), F.coalesce("jobtitle", F.lit("")).alias("t")).agg(F.min("words").alias("words"), F.max(detected_any()).alias("known"))
    hosts = each.groupBy("body", "host").agg(F.count(F.lit(1)).alias("n"), F.min("words").alias("words"), F.max("known").alias("known"))
    anywhere = each.groupBy("body", "t").agg(F.lit(1)).groupBy("body").agg(F.count(F.lit(1)).alias("titles"))
    return hosts.groupBy("body").agg(F.max("n").alias("host_titles"), F.min("words").alias("words"), F.max("known").alias("known")).join(anywhere, "body")


def message_odds(postings: DataFrame, bodies: DataFrame) -> DataFrame:
    """(body, odds): the mean log-odds of the terms of low bodies, in known messages against adverts that agree with their title."""
    spark = postings.sparkSession
    known = bodies.filter("known")
    n_known = known.count()
    unknown = bodies.filter(~F.col("known") & ((F.col("titles") >= MIN_TITLES) | (F.col("host_titles") >= MIN_HOST_TITLES)))
    if n_known < MIN_KNOWN:
        return bodies.select("body", F.lit(None).cast("double").alias("odds")).limit(0)
    said = unknown.select("body", F.size("words").alias("n"), F.explode("words").alias("term"))
    asked = materialize(said.select("term").distinct(), "terms")
    in_known = known.select(F.explode("words").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("k"))
    every = spark.createDataFrame([("",)], "term string")  # the empty term stands once in every advert and counts them
    wanted = asked.unionByName(every)
    adverts = told(postings).filter(~low() & agrees()).select(F.explode(F.concat(F.array(F.lit("")), "words")).alias("term"))
    in_adverts = materialize(adverts.join(F.broadcast(wanted) if is_small(asked) else wanted, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("a")), "advert-terms")
    n_adverts = next((r["a"] for r in in_adverts.filter("term = ''").collect()), 0)  # one row at most
    weights = asked.join(in_known, "term", "left").join(in_adverts, "term", "left").filter("k is not null or a is not null")
    odds = F.log((F.coalesce("k", F.lit(0)) + 0.5) / (n_known + 1.0)) - F.log((F.coalesce("a", F.lit(0)) + 0.5) / (n_adverts + 1.0))
    return said.join(weights.select("term", odds.alias("odds")), "term").groupBy("body", "n").agg((F.sum("odds") / F.col("n")).alias("odds")).select("body", "odds")


def evidence(postings: DataFrame) -> DataFrame:
    """:func:`flagged` with what is known of the low bodies, and the verdict ``residue``."""
    text = materialize(flagged(postings), "residue")  # flags, keys and the terms of low bodies, no text
    bodies = materialize(low_bodies(text), "bodies")
    odds = message_odds(postings, bodies)
    counted = materialize(bodies.select("body", "titles", "host_titles").join(odds, "body", "left"), "counted")
    shown = text.drop("words")
    few = semi_or_salted(shown.filter("low"), counted, ["body"], how="inner", salt_by=F.xxhash64("jobid"))
    rest = shown.filter("not low").withColumns({"titles": F.lit(0).cast("long"), "host_titles": F.lit(0).cast("long"), "odds": F.lit(None).cast("double")})
    unknown = F.col("low") & F.col("mismatch") & F.coalesce(F.col("odds") >= MIN_ODDS, F.lit(False))
    return few.unionByName(rest).withColumn("unknown_message", unknown).withColumn("residue", detected_any() | F.col("unknown_message"))
