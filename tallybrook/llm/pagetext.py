"""Main text of web pages by removal of site templates.

A page is read into elements; an element's digest covers its tag, its classes, its text and the digests
of its children, so equal subtrees have equal digests. Spark counts for each host how many different
pages hold a subtree. Subtrees that recur on many pages of the host are its template and go; then go
the elements that menus, notices, adverts, forms and the like are marked up as, which a host of a
few pages does not repeat; what is left of the article, where a page has one, is the text.

Prose in an article (paragraphs, headings, quotes, items of its lists) is never a template: authors
repeat sentences. Pages with the same prose count once, so that copies of an article do not make
its parts a template.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Container, Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import byte_batches, stage
from tallybrook.llm.urls import host_of

#: Different pages of a host that hold a template's subtree: at least so many, and so large a share.
#: The share bounds a host's templates by 1 / MIN_SHARE times the elements of an average page.
MIN_PAGES, MIN_SHARE = 4, 0.01

# Fixed values of HTML: elements without content, blocks, and what an open element ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td "
    "textarea tfoot th thead title tr ul".split()
)
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
ENDS_PARAGRAPH = BLOCKS - frozenset("body button caption dd dt head html legend li option select tbody td textarea tfoot th thead title tr".split())
SCOPES = frozenset("ul ol dl table select td th button article main nav section aside div body html".split())
# Elements that are never text of an article, and roles, classes and ids that say so of others.
JUNK_TAGS = frozenset(
    "script style template noscript head title nav footer aside form iframe object canvas svg math audio video select option button "
    "input textarea datalist dialog menu search fieldset".split()
)
JUNK_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
JUNK_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted banner nav navbar navigation menu breadcrumb "
    "breadcrumbs footer sidebar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended recommendations teaser teasers comment comments respond replies disqus widget widgets "
    "pagination pager toolbar masthead skip".split()
)
HEADER_WORDS = frozenset(["header", "topbar"])
KEPT = frozenset(["html", "body", "article", "main"])
#: What keeps an end or an implied end from reaching further out.
BARRIERS = {tag: SCOPES - ended for tag, ended in ENDED_BY.items()}
#: A tag that the page's end cuts is markup, too.
TAG_START = re.compile(r"<[a-zA-Z/!?]")
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd figcaption ul ol dl".split())

READ_DDL = "host string, signature binary, subtrees array<binary>"
TEXT_DDL = "text string, n_chars long, n_template int"


@lru_cache(maxsize=10_000)
def _label_words(label: str) -> tuple[bool, bool]:
    """Whether a class and id say junk, and whether they say header."""
    words = re.findall("[a-z]+", re.sub("([a-z])([A-Z])", r"\1 \2", label).lower())
    negated = {w for v, w in zip(words, words[1:]) if v in ("no", "has", "with", "without")}
    words = set(words) - negated
    return not words.isdisjoint(JUNK_WORDS), not words.isdisjoint(HEADER_WORDS)


class _Page(HTMLParser):
    """A page's elements in the order in which they open, and its pieces of text.

    ``pieces`` holds (element, text) and None where a block begins or ends.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.junk, self.digests, self.pieces = ["#page"], [-1], [False], [b""], []
        self.open, self.hashes = [0], [hashlib.blake2b(digest_size=16)]
        self.counts: dict[str, int] = {}  # open elements by tag

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_PARAGRAPH and self.counts.get("p"):
            self._close(("p",), ())
        if tag in ENDED_BY:
            self._close(ENDED_BY[tag], BARRIERS[tag])
        if tag in BLOCKS:
            self.pieces.append(None)
        elif tag == "br":
            self.pieces.append((self.open[-1], " "))
        label = role = ""
        if attrs:
            named = dict(reversed(attrs))
            label = f"{named.get('class') or ''} {named.get('id') or ''}".strip()
            role = (named.get("role") or "").strip().lower()
        self.tags.append(tag)
        self.parents.append(self.open[-1])
        self.junk.append(tag in JUNK_TAGS or self._is_junk(tag, label, role))
        self.digests.append(b"")
        digest = hashlib.blake2b(f"{tag}\0{label}\0".encode("utf-8", "surrogatepass"), digest_size=16)
        if tag in VOID:
            self.digests[-1] = digest.digest()
            self.hashes[-1].update(b"\1" + self.digests[-1])
            return
        self.open.append(len(self.tags) - 1)
        self.hashes.append(digest)
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash does not end an HTML element

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.pieces.append(None)
        if self.counts.get(tag):
            # An end tag inside a container does not end what is open outside of it.
            self._close((tag,), () if tag in SCOPES else SCOPES)

    def handle_data(self, data: str) -> None:
        self.pieces.append((self.open[-1], data))
        words = " ".join(data.split())
        if words:
            self.hashes[-1].update(b"\2" + words.encode("utf-8", "surrogatepass"))

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not needed

    def _close(self, tags: Container[str], scopes: Container[str]) -> None:
        """End the innermost open element of these tags and all in it, unless a scope is nearer."""
        at = len(self.open) - 1
        while at and self.tags[self.open[at]] not in tags:
            if self.tags[self.open[at]] in scopes:
                return
            at -= 1
        while at and len(self.open) > at:
            self._pop()

    def _pop(self) -> None:
        element, digest = self.open.pop(), self.hashes.pop().digest()
        self.counts[self.tags[element]] -= 1
        self.digests[element] = digest
        self.hashes[-1].update(b"\1" + digest)

    def _is_junk(self, tag: str, label: str, role: str) -> bool:
        if tag in ("html", "body", "main"):
            return False
        if tag == "article" and self.counts.get("article"):
            return True  # an article in an article is a comment or a pointer to another one
        if tag == "header" and not self._inside():
            return True
        if not label and not role:
            return False
        junk, header = _label_words(label)
        return junk or role in JUNK_ROLES or (header and not self._inside())

    def _inside(self) -> bool:
        return bool(self.counts.get("article") or self.counts.get("main"))

    def finish(self) -> _Page:
        self.close()
        while len(self.open) > 1:
            self._pop()
        # What surrounds an article is no junk itself, whatever its class says.
        around = [False] * len(self.tags)
        for i in range(len(self.tags) - 1, 0, -1):
            around[self.parents[i]] |= around[i] or (self.tags[i] in ("article", "main") and not self.junk[i])
        for i, tag in enumerate(self.tags):
            if around[i] and tag in ("div", "section", "form", "table", "tbody", "tr", "td", "center", "span", "header"):
                self.junk[i] = False
        return self

    def passed_down(self, marked: list[bool]) -> list[bool]:
        """Marks of the elements and of all that is in a marked one."""
        out = list(marked)
        for i in range(1, len(out)):
            out[i] = out[i] or out[self.parents[i]]
        return out

    def in_article(self) -> list[bool]:
        return self.passed_down([t in ("article", "main") for t in self.tags])

    def subtrees(self) -> list[bytes]:
        """Digests, each once, of the elements that may belong to a template."""
        article, around = self.in_article(), [False] * len(self.tags)
        for i in range(len(self.tags) - 1, 0, -1):
            around[self.parents[i]] |= around[i] or self.tags[i] in KEPT
        found = {}
        for i in range(1, len(self.tags)):
            prose = article[i] and (self.tags[i] in PROSE or self.tags[i] not in BLOCKS)
            if not around[i] and self.tags[i] not in KEPT and self.tags[i] not in VOID and not prose:
                found[self.digests[i]] = None
        return list(found)

    def blocks(self, gone: list[bool]) -> list[str]:
        out, held = [], []
        for piece in [*self.pieces, None]:
            if piece is not None:
                if not gone[piece[0]]:
                    held.append(piece[1])
            elif held:
                text = " ".join("".join(held).split())
                held = []
                if text:
                    out.append(text)
        return out

    def main_text(self, templates: set[bytes]) -> tuple[str, int]:
        """(text, subtrees removed as the host's template)."""
        article = self.in_article()
        template = [
            d in templates and not (article[i] and (self.tags[i] in PROSE or self.tags[i] not in BLOCKS)) for i, d in enumerate(self.digests)
        ]
        gone = self.passed_down([t or j for t, j in zip(template, self.junk)])
        for tag in ("article", "main"):
            roots = [t == tag and not g for t, g in zip(self.tags, gone)]
            if any(roots):
                inside = self.passed_down(roots)
                gone = [g or not i for g, i in zip(gone, inside)]
                break
        return "\n".join(self.blocks(gone)), sum(template)

    def signature(self) -> bytes:
        """Digest of the prose: equal for copies of an article."""
        article = self.in_article()
        gone = [not a for a in article] if any(article) else self.passed_down(self.junk)
        return hashlib.blake2b("\n".join(self.blocks(gone)).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def read_page(html: str | None) -> _Page:
    """The elements of a page, whatever is wrong with its markup."""
    page = _Page()
    html = (html or "").replace("\0", "\ufffd")
    cut = TAG_START.search(html, html.rfind(">") + 1)
    page.feed(html[: cut.start()] if cut else html)
    return page.finish()


def host_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, subtrees) of every host with recurring subtrees: digests of those that at least
    ``min_pages`` and ``min_share`` of the host's different pages hold.

    Subtrees are counted by (host, subtree), in tasks first, so a host with a third of all pages is
    spread by its subtrees. Pages without a host have no template.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_batches(batches, "html"):
            read = [read_page(html) for html in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["host"], pa.array([p.signature() for p in read], pa.binary()), pa.array([p.subtrees() for p in read], pa.list_(pa.binary()))],
                names=["host", "signature", "subtrees"],
            )

    read = pages.select(host_of(F.col("url")).alias("host"), "html").where("host <> ''").mapInArrow(run, READ_DDL)
    # One page for each text of a host; of copies in other surroundings any, settled by the write.
    read = stage(read.groupBy("host", "signature").agg(F.min("subtrees").alias("subtrees")), "page-subtrees")
    sizes = read.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = read.select("host", F.explode("subtrees").alias("subtree")).groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("held"))
    often = counts.where(F.col("held") >= min_pages).join(sizes, "host").where(F.col("held") >= min_share * F.col("pages"))
    return often.groupBy("host").agg(F.collect_list("subtree").alias("subtrees"))


def extract_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(page_id, url, text, n_chars, n_template) of every page.

    ``text``: the article's blocks, joined by line feeds, white space inside a block as one space;
    empty where nothing is left or the page is null. ``n_template`` subtrees went as the host's
    template. Whole pages are read, broken markup included: open elements end with what holds them.
    Repeated rows each have their row and count once for the template; null urls and ids are kept.
    """
    templates = stage(host_templates(pages, min_pages, min_share), "host-templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, set[bytes]] = {}  # of the hosts of one batch
        for batch in byte_batches(batches, "html"):
            known.clear()
            texts, removed = [], []
            for host, subtrees, html in zip(batch["host"].to_pylist(), batch["subtrees"], batch["html"].to_pylist()):
                if host not in known:
                    known[host] = set(subtrees.as_py() or ())
                text, count = read_page(html).main_text(known[host])
                texts.append(text.encode("utf-8", "replace").decode())
                removed.append(count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"], batch["url"], pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int32()),
                ],
                names=["page_id", "url", "text", "n_chars", "n_template"],
            )

    columns = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    return columns.join(templates, "host", "left").select("page_id", "url", "html", "host", "subtrees").mapInArrow(
        run, f"page_id long, url string, {TEXT_DDL}"
    )
