"""Links of HTML catalogs: for one page on the driver, and for tables of pages as DataFrame operations."""

from __future__ import annotations

from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone import contracts as C

LIMIT = 8 << 20
HREF = r"""(?i)href\s*=\s*["']([^"'<>\s]*)["']"""


class CatalogError(ValueError):
    """A catalog page that does not list what it should."""


def trusted(url: str, host: str) -> bool:
    """https, exactly this host, and neither port, user, query nor fragment."""
    try:
        parts = urlsplit(url)
        return parts.scheme == "https" and parts.netloc == host and not parts.query and not parts.fragment
    except ValueError:
        return False


class _Section(HTMLParser):
    def __init__(self, begin: str, end: str | None) -> None:
        super().__init__()
        self.begin, self.end, self.inside, self.heading, self.title, self.links = begin, end, False, False, "", []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "h2":
            self.heading, self.title = True, ""
        if tag == "a" and self.inside and (href := dict(attrs).get("href")):
            self.links.append(href)

    def handle_data(self, data: str) -> None:
        if self.heading:
            self.title += data

    def handle_endtag(self, tag: str) -> None:
        if tag == "h2":
            title = " ".join(self.title.split())
            self.heading = False
            self.inside = title == self.begin or self.inside and title != self.end


@dataclass(frozen=True)
class Artifact:
    url: str
    filename: str
    family: str
    role: str
    order: tuple[int, int] = field(default=(0, 0), compare=False)


def discover(html: str, base: str, host: str, begin: str, end: str | None, allowed: dict[str, tuple[str, str]]) -> list[Artifact]:
    """The allowed files linked between two headings, by family and role; a missing or repeated one is an error.

    ``allowed`` maps a lower-case file name to its family and role.
    """
    if len(html.encode()) > LIMIT:
        raise CatalogError("the catalog is too large")
    page = _Section(begin, end)
    page.feed(html)
    found: dict[str, Artifact] = {}
    for href in page.links:
        url = urljoin(base, href)
        name = urlsplit(url).path.rpartition("/")[2]
        if name.lower() not in allowed:
            continue
        if not trusted(url, host):
            raise CatalogError(f"untrusted link {url}")
        if name.lower() in found:
            raise CatalogError(f"{name} is linked twice")
        family, role = allowed[name.lower()]
        found[name.lower()] = Artifact(url, name, family, role, (list(C.FAMILIES).index(family), C.ROLES[role]))
    missing = sorted(set(allowed) - set(found))
    if missing:
        raise CatalogError(f"missing from the catalog: {', '.join(missing)}")
    return sorted(found.values(), key=lambda a: (a.order, a.filename))


def grid_problems(pairs: list[tuple[str, str]]) -> list[str]:
    """Combinations of family and role that are missing or repeated."""
    return [f"{f}/{r}: {n}" for f in C.FAMILIES for r in C.ROLES if (n := pairs.count((f, r))) != 1]


def page_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id_col, position, href) of every link in a table of pages, in order."""
    links = F.regexp_extract_all(F.col(html_col), F.lit(HREF), 1)
    return pages.select(id_col, F.posexplode(links).alias("position", "href"))


def trusted_column(url: Column, host: str) -> Column:
    """:func:`trusted` as an expression."""
    plain = url.rlike(r"^https://[^/?#@:]+(/[^?#]*)?$")
    return F.coalesce(plain & (F.regexp_extract(url, r"^https://([^/?#]*)", 1) == host), F.lit(False))
