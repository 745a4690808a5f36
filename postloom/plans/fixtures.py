"""Small pages, written for the operators that read HTML, with what must come out."""

from __future__ import annotations

BASE = "https://www.jobindex.dk"


def _posting(ident: str, title: str | None, href: str | None, company: str = "", place: str = "", pictures: str = "", date: str = "") -> str:
    link = f'<h4><a href="{href}">{title}</a></h4>' if href is not None else f"<h4>{title}</h4>"
    return f'<div id="{ident}">{company}{link}{place}{pictures}{date}</div>'


_COMPANY = '<div class="jix-toolbar-top__company x"><a href="/virksomhed/7">Acme <b>A/S</b></a></div>'
_PLACE = '<div class="jobad-element-area"><span> Aarhus </span><span>x</span></div>'
_DATE = '<div class="jix-toolbar__pubdate"><time datetime="2025-03-04T05:06:07">4. marts</time></div>'
_TWO = '<div class="PaidJob-inner"><center><img src="/a.png"></center><center><img src="//cdn/b.png"></center></div>'
_ONE = '<div class="PaidJob-inner"><center><img src="c.png"></center></div>'

LISTING_PAGES = [
    ("subid_1", 1, f"{BASE}/jobsoegning?subid=1", '<span class="filter-button__label"> Salg </span>' + _posting("jobad-wrapper-1", "Foo <b>Bar</b>", "/vis/1", _COMPANY, _PLACE, _TWO, _DATE) + _posting("jobad-wrapper-2", "Kok", "vis/2", pictures=_ONE)
     + _posting("jobad-wrapper-3", "uden link", None) + _posting("other-5", "nej", "/vis/5", _COMPANY)),
    ("subid_2", 1, f"{BASE}/jobsoegning?subid=2", _posting("jobad-wrapper-4", "Smed", "https://x.example/4", date=_DATE.replace("2025-03-04T05:06:07", "i dag")) + _posting("jobad-wrapper-6", "Tom", "")),
    ("subid_3", 2, f"{BASE}/jobsoegning?subid=3", '<span class="filter-button__label"></span>' + _posting("jobad-wrapper-7", "Lærer", "/vis/7", '<div class="jix-toolbar-top__company"><a>Skolen</a></div>')),
]

LISTED = [
    ("Salg", 1, "FooBar", "/vis/1", "AcmeA/S", f"{BASE}/virksomhed/7", "Aarhus", f"{BASE}/a.png", f"{BASE}//cdn/b.png", "2025-03-04 05:06:07"),
    ("Salg", 1, "Kok", "vis/2", None, None, None, "c.png", "c.png", None),
    ("subid_2", 1, "Smed", "https://x.example/4", None, None, None, None, None, None),
    ("", 2, "Lærer", "/vis/7", "Skolen", None, None, None, None, None),
]

A31, A30, B40 = "a" * 31, "b" * 30, "Vi søger en kollega til vores lager nu. "[:39] + "x"
_FRAME = "Søg job Vælg mellem flere søgekriterier"
DETAIL_PAGES = [
    ("https://x.systematic.com/1", 200, f'<div class="job"><p>{A31}</p><p>{A30}</p></div><p>{B40}</p>'),
    (f"{BASE}/jobannonce/2", 200, f'<div class="job"><p>{B40}</p></div><div class="jobtext y"><h2>{A31}</h2></div>'),
    ("https://candidate.hr-manager.net/3", 200, f'<div class="AdContentContainer"><ul><li>{A31}<p>{B40}</ul></div>'),
    ("https://a.myworkdayjobs.com/4", 200, f'<div data-automation-id="job-posting-details" class="css-11p01j8"><span>{A31}</span></div>'),
    ("https://jyskebank.dk/5", 200, f'<div class="umb-richtext"></div><div class="Myjobs"><p>{A31}</p></div>'),
    ("https://kirklarsen.dk/6", 200, f'<div class="js-primary-contents-container"><p>{A31}</p></div>'),
    ("https://jobbank.dk/7", 200, f'<div class="jobText"><p>{A31}</p><script>{B40}</script></div>'),
    ("https://x.oraclecloud.com/8", 200, f'<div class="job-details__description-content"><li>{A31}</li></div>'),
    ("https://plain.example/9", 200, f'<div class="Posting"><p>{A31}</p></div><p>{B40}</p>'),
    ("https://plain.example/10", 200, f"<h1>{A31}</h1><p>{B40}<p>{A30}"),
    ("https://plain.example/11", 200, f'<div data-automation-id="Job_Posting_Details"><p>{A31}</p></div>'),
    (f"{BASE}/vis/12", 200, f'<div class="jobcontent"><p>{_FRAME} {A31}</p></div>'),
    (f"{BASE}/jobannonce/13", 200, f'<div class="jobtext"><p>{_FRAME} {A31}</p></div>'),
    ("https://plain.example/14", 404, f"<p>{A31}</p>"),
    ("https://plain.example/15", 200, ""),
]
MAIN_TEXTS = [
    ("https://x.systematic.com/1", A31), (f"{BASE}/jobannonce/2", A31), ("https://candidate.hr-manager.net/3", f"{A31} {B40}\n{B40}"), ("https://a.myworkdayjobs.com/4", A31), ("https://jyskebank.dk/5", A31),
    ("https://kirklarsen.dk/6", A31), ("https://jobbank.dk/7", A31), ("https://x.oraclecloud.com/8", A31), ("https://plain.example/9", A31), ("https://plain.example/10", f"{A31}\n{B40} {A30}\n{A30}"[: 31 + 1 + 40 + 1 + 30]),
    ("https://plain.example/11", A31), (f"{BASE}/vis/12", f" {A31}"), (f"{BASE}/jobannonce/13", f"{_FRAME} {A31}"), ("https://plain.example/15", ""),
]


def _next(url: str) -> str:
    return f'<ul class="pagination"><li class="page-item page-item-next"><a href="{url}">næste</a></li></ul>'


STARTS = [("subid_1", "https://b.example/s?subid=1"), ("subid_2", "https://b.example/s?subid=2"), ("subid_3", "https://b.example/s?subid=3")]
SAVED_PAGES = [
    ("https://b.example/s?subid=1", _next("/s?subid=1&page=2")), ("https://b.example/s?subid=1&page=2", _next("https://b.example/s?subid=1&page=3")), ("https://b.example/s?subid=1&page=3", "<p>slut</p>"),
    ("https://b.example/s?subid=2", "<h1>Siden kan ikke findes</h1>"), ("https://b.example/s?subid=3", _next("/s?subid=3&page=2")),
]
LINKED_PAGES = [
    ("subid_1", "https://b.example/s?subid=1", "https://b.example/s?subid=1&page=2"), ("subid_1", "https://b.example/s?subid=1&page=2", "https://b.example/s?subid=1&page=3"), ("subid_1", "https://b.example/s?subid=1&page=3", None),
    ("subid_3", "https://b.example/s?subid=3", "https://b.example/s?subid=3&page=2"),
]
READ_PAGES = [("subid_1", 1, "https://b.example/s?subid=1"), ("subid_1", 2, "https://b.example/s?subid=1&page=2"), ("subid_1", 3, "https://b.example/s?subid=1&page=3"), ("subid_3", 1, "https://b.example/s?subid=3")]
