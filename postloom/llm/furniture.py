"""What the furniture of job pages says, line by line: breaks the tie where problem 6's alignment does not decide.

``Roles`` answers whether a line's constant words are those of navigation, notices, share prompts, teasers of other
adverts and so on. It knows words of five languages and no site, and remembers lines it has seen (bounded).
"""

from __future__ import annotations

import re

import ahocorasick

# The entries of menus and footers, per language.
MENU = set(
    "|".join(
        [
            "forside|søg job|ledige job|min side|log ind|log ud|opret agent|opret jobagent|gemte job|virksomheder|arbejdsgivere|nyheder|kurser|karriere|kontakt|kontakt os|hjælp|om os|om|english|dansk|menu|menu ☰|luk|luk ✕|profil|cv|cookies|job|jobagent|favoritter|indstillinger",
            "home|search jobs|vacancies|my page|log in|log out|sign in|create alert|saved jobs|companies|employers|news|courses|careers|contact|contact us|help|about|about us|close|close ✕|jobs|profile|settings|all jobs",
            "hem|sök jobb|lediga jobb|mina sidor|logga in|skapa bevakning|sparade jobb|företag|arbetsgivare|nyheter|karriär|kontakta oss|hjälp|om oss|svenska|meny|stäng|jobb",
            "hjem|søk jobb|ledige stillinger|logg inn|lag jobbvarsel|lagrede stillinger|bedrifter|arbeidsgivere|nyheter|kurs|kontakt oss|hjelp|norsk|meny|lukk",
            "startseite|stellensuche|stellenangebote|meine seite|anmelden|suchauftrag anlegen|gemerkte stellen|unternehmen|arbeitgeber|aktuelles|kurse|hilfe|über uns|deutsch|menü|schließen|stellen|jobs suchen",
            "handelsbetingelser|privatliv|tilgængelighed|sitemap|vilkår|persondatapolitik|terms|privacy|accessibility|villkor|integritet|tillgänglighet|webbkarta|personvern|tilgjengelighet|nettstedskart|agb|datenschutz|barrierefreiheit|übersicht|impressum",
            "lønberegner|karrieretest|cv-skabeloner|pay calculator|career test|resume templates|lönekalkylator|karriärtest|cv-mallar|lønnskalkulator|gehaltsrechner|lebenslaufvorlagen",
            "accepter alle|kun nødvendige|vis detaljer|accept all|necessary only|show details|godkänn alla|endast nödvändiga|visa detaljer|godta alle|alle akzeptieren|nur notwendige|einzelheiten anzeigen|afvis alle|reject all",
            "forrige|næste|previous|next|föregående|nästa|neste|zurück|weiter|« forrige|næste »|« previous|next »|« föregående|nästa »|neste »|« zurück|weiter »|del|print|e-mail|kopiér link|copy link|kopiera länk|kopier lenke|link kopieren|e-post|share|dela",
            "fuldtid ✕|nulstil|full time ✕|reset|heltid ✕|nollställ|nullstill|vollzeit ✕|zurücksetzen|deltid ✕|part time ✕",
        ]
    ).split("|")
)
#: Entries that, alone on a line, are headings of an advert.
HEADINGS = {"om os", "om oss", "about us", "about", "über uns", "om", "profil", "profile", "job", "jobs", "cv", "vilkår", "cookies"}

# Word patterns of furniture (at the start of a line, or anywhere); H stands for a host name, 0 for digits.
ANCHORED = re.compile(
    "|".join(
        [
            r"^(?:ved at klikke videre|by continuing you|genom att fortsätta|ved å fortsette|mit dem weiter)",
            r"^(?:spring til|skip to|hoppa till|hopp til|zum inhalt)\b",
            r"^(?:tilbage )?til toppen$",
            r"^back to top$",
            r"^till toppen$",
            r"^nach oben$",
            r"^du er her:",
            r"^you are here:",
            r"^du är här:",
            r"^sie sind hier:",
            r"^menu?y?ü?\s*☰",
            r"^«.*»$",
            r"^(?:viser|showing|visar|zeige) 0 (?:af|of|av|von) 0\b",
            r"^(?:side|page|sida|seite) 0 (?:af|of|av|von) 0\b",
            r"^filt(?:re|ers?|rer)\s*:",
            r"^(?:hjem|hem|home|forside|startseite|job|jobs|jobb|stellen)\s*[>/›»]\s",
            r"^(?:del|dela|share) (?:opslaget|annoncen|annonsen|this|jobbet)\b",
            r"^anzeige teilen\b",
            r"^tip en ven\b",
            r"^tell a friend\b",
            r"^tipsa en vän\b",
            r"^tips en venn\b",
            r"^empfehlen sie\b",
            r"^følg os p[åa]\b",
            r"^follow us on\b",
            r"^följ oss i\b",
            r"^følg oss i\b",
            r"^folgen sie uns\b",
            r"^har du glemt din adgangskode",
            r"^forgotten your password",
            r"^glömt lösenordet",
            r"^glemt passordet",
            r"^passwort vergessen",
            r"^nyhed?s?bre[vf]\b.*:",
            r"^newsletter\s*:",
            r"^nyhetsbrev\s*:",
            r"^(?:få|get|neue) (?:nye|new|nya|stellen|ny)\b.*(?:mail|e-post|mejl)\b",
            r"^(?:andre ledige|flere ledige|fler lediga|more vacancies|weitere stellen|ledige stillinger i nærheden|other vacancies)\b",
            r"^(?:udvalgte|utvalgte|utvalda|featured|selected|ausgewählte) (?:job|jobs|jobb|stillinger|stellen|vacancies)\b",
            r"^job(?:s)? på forsiden$",
            r"^(?:featured|front page) (?:jobs|vacancies)",
            r"^jobs on the front page",
            r"^(?:andre så også|others also viewed|andra tittade också|ande?re sahen auch)\b",
            r"^(?:lignende|similar|liknande|ähnliche) (?:stillinger|job|jobs|positions|tjänster|stellen)\b",
            r"^(?:populære|popular|populära|beliebte) (?:søgninger|søk|searches|sökningar|suchen)\b",
            r"^(?:se alle|see all|se alla|alle) 0 (?:job|jobs|jobb|stillinger|stellen|tjänster)\b",
            r"^(?:mest læste|most read|mest lästa|mest leste|meistgelesen)",
            r"^annonce: ",
            r"^advert: ",
            r"^annons: ",
            r"^annonse: ",
            r"^anzeige: ",
            r"^sponsor",
            r"^vejret i\b",
            r"^weather in\b",
            r"^vädret i\b",
            r"^været i\b",
            r"^(?:das )?wetter in\b",
            r"^hvor tilfreds er du med siden",
            r"^how do you like this page",
            r"^hur nöjd är du med",
            r"^hvor fornøyd er du",
            r"^prøv vores app",
            r"^try our app",
            r"^prova vår app",
            r"^prøv appen",
            r"^testen sie unsere app",
            r"^rapport[eé]r en fejl",
            r"^report a problem",
            r"^rapportera ett fel",
            r"^meld fra om feil",
            r"^fehler melden",
            r"^åbningstider for kundeservice",
            r"^help desk hours",
            r"^kundtjänst",
            r"^kundeservice:",
            r"^öffnungszeiten",
            r"^(?:siden|denne side|this page|sidan|die seite|page)\b.*\b(?:sidst opdateret|last updated|senast uppdaterad|sist oppdatert|zuletzt aktualisiert)\b",
            r"^©",
            r"^\(c\) 0",
            r"^(?:cvr|org\.? ?nr|company no|register-?nr|hrb)\b\.?[\s:]*0",
            r"^(?:opslaget|annoncen|annonsen|this advert|this ad|diese anzeige|dette opslag)\b.*\b(?:leveret af|supplied by|levererats av|levert av|geliefert|vist 0|shown 0|visats 0)\b",
            r"^persond?ata?\b.*0 (?:dage|days|dagar|dager|tage)\b",
            r"^personal data\s*:",
            r"^personuppgifter\s*:",
            r"^personvern\s*:",
            r"^datenschutz\s*:",
            r"^(?:annonce|annonse|annons|advert|anzeige)\.? (?:nr|no)\b\.? ?0",
            r"^(?:skrevet af|written by|skriven av|skrevet av|geschrieben von)\b.*\b(?:H|0)\b",
            r"^redaktør \w\.? ",
            r"^editor \w\.? ",
            r"^(?:ansvarshavende|editor in charge|ansvarig utgivare|ansvarlig redaktør|verantwortlich)\b\s*:",
            r"^(?:søger du medarbejdere|are you hiring|söker du medarbetare|søker du medarbeidere|suchen sie personal)\b",
            r"^(?:læs også|read also|läs också|les også|lesen sie auch)\b",
            r"^(?:log ind|log in|logga in|logg inn) for at\b",
        ]
    )
)
FREE = re.compile(
    "|".join(
        [
            r"\bcookies?\b.*(?:statisti|bruger|use|samtyk|consent|verwenden|använder|informasjon|politik)",
            r"\b(?:informasjonskapsler|kakor)\b",
            r"\bsmå filer\b",
            r"\bsmall files\b",
            r"\bkleine dateien\b",
            r"\b0 (?:samarbejdspartnere|partners?|partner|samarbeidspartnere|samarbetspartner)\b",
            r"\b(?:wir verwenden|vi använder|vi bruker|vi bruger|we use) (?:cookies|kakor|informasjonskapsler)",
            r"✕",
            r"(?:print denne side|print this page|skriv ut sid(?:an|en)|seite von \S+ drucken)",
            r"\[(?:tilmeld|sign up|anmäl|meld på|anmelden)\]",
            r"\bwebinar\b.* 0",
            r"\b0 (?:grader|degrees|grad)\b",
            r"★",
            r"\b(?:alle rettigheder forbeholdes|all rights reserved|alla rättigheter förbehållna|alle rettigheter forbeholdt|alle rechte vorbehalten)\b",
            r"\b(?:ikke ansvarlig for fejl i|not liable for errors in|ansvarar inte för fel|ikke ansvarlig for feil|haftet nicht für)\b",
            r"\b(?:er beskyttet|is protected|är skyddat|sind geschützt)\b.*\b(?:gengivelse|gjengis|reproduced|återges|wiedergegeben|aftale|agreement)\b",
            r"\b(?:udgiver|publisher|utgivare|herausgeber)\s*:",
            r"\b(?:henvendelser besvares|enquiries are answered|förfrågningar besvaras|henvendelser besvares|anfragen werden)\b.* 0",
            r"\b(?:er medlem af|is a member of|är medlem i|er medlem av|ist mitglied)\b.*\b(?:ordning|scheme|regler|rules|regeln)",
            r"\b(?:priser på annoncer|advert prices)\b",
        ]
    )
)
#: "Town: occupation", an entry of a list of other adverts; labels of an advert's own fields are none.
ENTRY = re.compile(
    r"^(?!(?:titel|title|stilling|job|jobtitel|sted|arbejdssted|location|by|ort|løn|lön|lønn|pay|gehalt|tlf|tel|kontakt|contact|frist|deadline|periode|start|om|din|dine|your|ihre?|vi|what|how|sådan|så|slik|so|wir|über|annonce|advert)\b)"
    r"(?:[A-ZÆØÅÄÖ][\w]+ )?[A-ZÆØÅÄÖ][\w]{3,}: [^\W\d_]{3,24}(?: [^\W\d_]{2,20}){0,2}$",
    re.I,
)
#: One of these stands in every line that an unanchored pattern can match.
FREE_GATE = ("cookie", "informasjonskapsler", "kakor", "små filer", "small files", "kleine dateien", "partner", "print denne", "print this", "skriv ut sid", "drucken", "✕", "[", "webinar", "grade", "grad", "degrees", "★", "©", "rettigheder", "rights", "rättigheter",
             "rettigheter", "rechte", "ansvarlig", "liable", "ansvarar", "haftet", "beskyttet", "protected", "skyddat", "geschützt", "udgiver", "publisher", "utgivare", "herausgeber", "besvar", "answered", "anfragen", "medlem", "member", "mitglied", "priser på", "advert prices")
_HOST = re.compile(r"\b(?!org\.nr)[\w\-]+(?:\.[\w\-]+)*\.[a-z]{2,}\b", re.I)
_SEPARATOR = re.compile(r"\s*[|·•]\s*|\s{2,}|\t+")


def items_of(line: str) -> list[str]:
    """Entries of a line that is cut up by bars, dots or wide gaps."""
    if not ("|" in line or "·" in line or "  " in line or "•" in line or "\t" in line):
        return [line.strip()] if line and not line.isspace() else []
    return [x for x in (p.strip() for p in _SEPARATOR.split(line.strip())) if x]


def masked(line: str) -> str:
    """Lower case, one blank for white space, digits 0, host names H."""
    return re.sub(r"\d+", "0", _HOST.sub("H", " ".join(line.split()).lower()))


_GATE = ahocorasick.Automaton()
for _word in FREE_GATE:
    _GATE.add_word(_word, True)
_GATE.make_automaton()


class Roles:
    def __init__(self, limit: int = 400_000):
        self.known: dict[str, bool] = {}
        self.limit = limit

    def furniture(self, line: str) -> bool:
        known = self.known.get(line)
        if known is None:
            if len(self.known) > self.limit:
                self.known.clear()
            known = self.known[line] = _furniture(line)
        return known


def _furniture(line: str) -> bool:
    s = line.strip()
    if not s:
        return False
    low = " ".join(s.lower().split())
    if low in MENU:
        return low not in HEADINGS
    entries = items_of(s.lower())
    if len(entries) >= 2 and sum(e in MENU for e in entries) * 2 > len(entries):
        return True
    low = re.sub(r"\d+", "0", _HOST.sub("H", low) if "." in low else low)
    if ANCHORED.match(low) or (":" in s and len(s) < 60 and s[0].isupper() and ENTRY.match(s)):
        return True
    return next(_GATE.iter(low), None) is not None and FREE.search(low) is not None
