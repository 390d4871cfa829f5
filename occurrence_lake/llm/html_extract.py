"""Main text of html pages by consensus paths of their hosts.

A page is cut into text blocks, each under the path of its containers; a
step of a path is the tag and its classes without digits (*generalised*),
and a path is known by a 64-bit hash over its steps.  Blocks inside menus,
forms, scripts, notices, adverts, comments and the like are left out: by
tag, by attribute (hidden), or by the class, id or role of a container (not
of a paragraph or a phrase in it).  Where ``article`` or ``main`` hold half
of the characters outside links at least, only their text counts, and paths
are cut at that step.

*Vote.*  Each page scores its containers by the characters outside links in
them and votes for the lowest one that holds more than half.  Spark adds the
votes of every host; a path with more than half of them is its consensus.

*Extraction.*  With the consensus path the pages are read again.  Text in
it, below it or in a container around it stays.  Text of a container beside
it goes if the host shows it to be boilerplate: the container stands beside
the path, on pages of different main texts, and a text in it repeats on
more than half of the host's pages.  There are no bounds of size: what the
host does not repeat is kept, however short.  A page without the path, or of
a host without one, keeps all its blocks.

Text: character references decoded, white space inside a block (``br``
too) is one space, blocks in page order joined by a line feed.

Defined results: null or empty html has an empty text; a null url or one
without host votes with all such pages; of paths with equally many votes
none has more than half, so ties need no order, and of equally heavy
containers of a page none is stepped into; repeated rows give repeated results;
an empty table gives an empty result; further columns of the input, of any
name, are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occurrence_lake.llm.common import ship, written

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|iframe|noframes|noembed|xmp)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*>"
    r"|<(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>[^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HOST = r"^[^:]*://([^/?#]*)"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var "
                   "math mfenced mfrac mi mn mo mover mroot mrow ms msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
SKIPPED_TAGS = frozenset("head nav footer aside form button select option noscript template svg canvas audio video object dialog menu".split())
SKIPPED_NAMES = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo banner cookie cookies consent notice gdpr popup modal overlay "
                          "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer comment comments disqus respond reply replies share sharing social "
                          "related recommended newsletter subscribe signup login search pagination pager toolbar skip".split())
#: What may stand with a skipped name in a compound one (site-footer,
#: commentlist), and what turns its sense (no-sidebar, has-menu).
NEUTRAL = frozenset("area bar block bottom box col column container content form global header holder inner item items left links list main middle mobile page panel primary "
                    "right row secondary section site slot thread top unit widget wrap wrapper".split())
TURNED = frozenset("has is no non not with without".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES_SELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table article section div main body".split())
NO_CONTAINERS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li ul ol td th tr tbody table dl dt dd figure figcaption".split())
#: Tags that are left out by a name of theirs.
NAMED = frozenset("div section header ul ol dl table details fieldset center".split())


def boilerplate(name: str) -> bool:
    """Whether a class, id or role names boilerplate: a listed word, or a
    compound of listed and neutral words."""
    if name in SKIPPED_NAMES:
        return True
    parts = re.split(r"[-_]+", name)
    if len(parts) == 1:
        return any(name.startswith(w) and name[len(w):] in NEUTRAL or name.endswith(w) and name[:-len(w)] in NEUTRAL for w in SKIPPED_NAMES)
    if parts[0] in TURNED:
        return False
    listed = [boilerplate(x) for x in parts]
    return any(listed) and all(b or x in NEUTRAL for b, x in zip(listed, parts))


def names(attrs: str) -> tuple[list[str], set[str], bool]:
    """(generalised classes, generalised classes, ids and roles, hidden)."""
    classes, found, hidden = [], set(), False
    for kind, a, b, c in _ATTR.findall(attrs):
        kind, value = kind.lower(), (a or b or c).lower()
        if kind in ("class", "id", "role"):
            own = [x for x in (re.sub(r"\d+", "", w).strip("-_") for w in value.split()) if x]
            found.update(own)
            if kind == "class":
                classes += own
        elif kind == "hidden":
            hidden = hidden or value != "until-found"
        elif kind == "aria-hidden":
            hidden = hidden or value.strip() == "true"
    return sorted(set(classes)), found, hidden


class Paths:
    """The container paths of a page, numbered as they come; 0 is the page."""

    def __init__(self):
        self.parent, self.tag, self.key, self.marked = [0], [""], [0], [0]
        self._known: dict[tuple[int, str], int] = {}

    def below(self, path: int, tag: str, classes: list[str]) -> int:
        import xxhash

        step = ".".join([tag, *classes])
        found = self._known.get((path, step))
        if found is None:
            found = self._known[path, step] = len(self.parent)
            self.parent.append(path)
            self.tag.append(tag)
            self.key.append(xxhash.xxh64_intdigest(step.encode("utf-8", "replace"), self.key[path] & (2**64 - 1)))
            self.marked.append(self.marked[path] or (found if tag in ("article", "main") else 0))
        return found

    def container(self, path: int) -> int:
        """A block's own container: a paragraph, heading or cell is none,
        and what is inside ``article`` or ``main`` counts there."""
        if self.marked[path]:
            return self.marked[path]
        while self.tag[path] in NO_CONTAINERS:
            path = self.parent[path]
        return path

    def signed_key(self, path: int) -> int:
        return self.key[path] - 2**64 if self.key[path] >= 2**63 else self.key[path]


def blocks(page: str) -> tuple[Paths, list[tuple[int, str, int]]]:
    """(paths, (path, text, characters inside links) of every block that may
    be main text, in page order)."""
    paths = Paths()
    out: list[tuple[int, str, int]] = []
    stack: list[tuple[str, int, bool]] = [("", 0, False)]  # tag, path, skipped
    open_tags: dict[str, int] = {}
    parts: list[str] = []
    linked = in_link = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text and not stack[-1][2]:
                out.append((stack[-1][1], text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def close(upto: int) -> None:
        flush()
        for tag, _, _ in stack[upto:]:
            open_tags[tag] -= 1
        del stack[upto:]

    def say(piece: str) -> None:
        nonlocal linked
        if piece and not stack[-1][2]:
            piece = html_lib.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            if in_link:
                linked += len(piece)

    at = 0
    for m in _MARKUP.finditer(page):
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        tag, end = m.group("tag"), m.group("end")
        if tag:
            tag = tag.lower()
            if tag == "br":
                parts.append(" ")
                continue
            if tag == "a":
                in_link = 1
            attrs = m.group("attrs")
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            classes, own_names, hidden = names(attrs) if attrs and not attrs.isspace() else ([], set(), False)
            skip = (hidden or tag in SKIPPED_TAGS or tag == "header" and not paths.marked[stack[-1][1]] or tag in NAMED and any(map(boilerplate, own_names))
                    or tag == "article" and not {"comment", "comments", "ad", "sponsored"}.isdisjoint(own_names))
            if tag in INLINE and not skip:
                continue
            if tag in CLOSES_P and open_tags.get("p"):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        close(i)
                        break
                    if stack[i][0] not in INLINE:
                        break
            if tag in CLOSES_SELF:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in CLOSES_SELF[tag]:
                        close(i)
                        break
                    if stack[i][0] in SCOPES:
                        break
            flush()
            if tag in ("html", "body"):
                continue
            stack.append((tag, paths.below(stack[-1][1], tag, classes), stack[-1][2] or skip))
            open_tags[tag] = open_tags.get(tag, 0) + 1
        elif end:
            end = end.lower()
            if end == "a":
                in_link = 0
            if open_tags.get(end):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == end:
                        close(i)
                        break
            elif end not in INLINE:
                flush()
    if at < len(page):
        say(page[at:])
    flush()
    return paths, out


def main_blocks(page: str) -> tuple[Paths, list[tuple[int, str, int]]]:
    """Paths and blocks, each with its container; only those of ``article``
    and ``main`` where these hold half of the text outside links at least."""
    paths, found = blocks(page)
    weight = lambda some: sum(len(text) - linked for _, text, linked in some)
    marked = [b for b in found if paths.marked[b[0]]]
    if marked and 2 * weight(marked) >= weight(found):
        found = marked
    return paths, [(paths.container(path), text, linked) for path, text, linked in found]


def best_container(paths: Paths, found: list[tuple[int, str, int]]) -> tuple[int, int]:
    """The page's vote: the lowest container that holds more than half of
    the characters outside links, and all of these."""
    mass = [0] * len(paths.parent)
    for path, text, linked in found:
        mass[path] += len(text) - linked
    total = sum(mass)
    for path in range(len(mass) - 1, 0, -1):  # a path comes after the one around it
        mass[paths.parent[path]] += mass[path]
    top = 0
    for path in range(1, len(mass)):
        if paths.parent[path] == top and 2 * mass[path] > total:
            top = path
    return top, total


def around(paths: Paths, path: int) -> set[int]:
    """A path and all that it lies in."""
    out = {0}
    while path:
        out.add(path)
        path = paths.parent[path]
    return out


def below(paths: Paths, path: int) -> set[int]:
    """A path and all that lies in it."""
    out = {path}
    for p in range(path + 1, len(paths.parent)):
        if paths.parent[p] in out:
            out.add(p)
    return out


def page_vote(page: str) -> tuple[int, int, int, list[tuple[int, int]]]:
    """(key of the path, characters, hash of the text at the path,
    (container, hash of text) of the blocks beside it, and the path itself)."""
    import xxhash

    digest = lambda t: xxhash.xxh64_intdigest(t.encode("utf-8", "replace")) - 2**63
    paths, found = main_blocks(page)
    top, score = best_container(paths, found)
    own, near = below(paths, top), around(paths, top)
    beside = {(paths.signed_key(path), digest(text)) for path, text, _ in found if path not in own and path not in near}
    beside.add((paths.signed_key(top), 0))  # that the page has it; its texts need no count
    return paths.signed_key(top), score, digest("\n".join(text for path, text, _ in found if path in own)), sorted(beside)


def main_text(page: str | None, consensus: int | None, boilerplate_paths: list[int] | None = None) -> str:
    """The page's blocks but those of its host's boilerplate containers, if
    it has text at the consensus path."""
    paths, found = main_blocks(page or "")
    junk = set(boilerplate_paths or ())
    if consensus is not None and junk:
        top = next((p for p in range(len(paths.parent)) if paths.signed_key(p) == consensus), None)
        if top is not None and any(path in (own := below(paths, top)) for path, _, _ in found):
            stay = own | around(paths, top)
            found = [b for b in found if b[0] in stay or paths.signed_key(b[0]) not in junk]
    return "\n".join(text for _, text, _ in found)


def host_paths(pages: DataFrame) -> DataFrame:
    """``host``, its ``consensus`` path and the paths of its ``boilerplate``
    containers, from the votes of all its pages (columns ``host``,
    ``html``).  Votes are counted before the shuffle: what a host sends from
    a task is a row for each path and text that its pages do not share."""
    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [page_vote(h.as_py() or "") for h in batch.column(1)]
            beside = pa.array([[(None, None), *g[3]] for g in got], pa.list_(pa.struct([("container", pa.int64()), ("text", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()),
                                              pa.array([g[2] for g in got], pa.int64()), beside], names=["host", "path", "score", "main", "beside"])

    voted = pages.select("host", "html").mapInArrow(
        votes, "host string, path bigint, score bigint, main bigint, beside array<struct<container:bigint,text:bigint>>").where("score > 0")
    each = voted.select("host", "path", "main", F.explode("beside").alias("b")).select("host", "path", "main", "b.container", "b.text")
    counted = written(each.groupBy("host", "path", "container", "text").agg(F.count("*").alias("n"), F.min("main").alias("least"), F.max("main").alias("most")), "host-votes")
    best = (counted.where("container is null").groupBy("host").agg(F.max_by(F.struct("path", "n"), F.struct("n", "path")).alias("best"), F.sum("n").alias("pages"))
            .where(2 * F.col("best.n") > F.col("pages")).select("host", F.col("best.path").alias("path"), "pages"))
    texts = (counted.where("container is not null").groupBy("host", "container", "text")
             .agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")))
    shown = (texts.join(best, "host").groupBy("host", "container", "pages")
             .agg(F.max("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
             .where((F.col("least") < F.col("most")) & (2 * F.col("n") > F.col("pages"))))
    junk = shown.groupBy("host").agg(F.collect_list("container").alias("boilerplate"))
    return best.join(junk, "host", "left").select("host", F.col("path").alias("consensus"), F.coalesce("boilerplate", F.array().cast("array<bigint>")).alias("boilerplate"))


def extract_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", by_host: bool = True) -> DataFrame:
    """One row per input row: id, url, ``text``, ``n_chars``.  Without
    ``by_host`` every page is read by itself, without votes."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), _HOST, 1))
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    # Written: its file size decides whether the join broadcasts the paths.
    paths = written(host_paths(pages if by_host else pages.limit(0)), "host-paths")
    id_type, url_type = (df.schema[c].dataType.simpleString() for c in (id_col, url_col))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                texts = [main_text(h.as_py(), c.as_py(), b.as_py()) for h, c, b in zip(part.column(2), part.column(3), part.column(4))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                                 names=["id", "url", "text", "n_chars"])

    joined = pages.join(paths, "host", "left").select("id", "url", "html", "consensus", "boilerplate")
    out = joined.mapInArrow(extracted, f"id {id_type}, url {url_type}, text string, n_chars bigint")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")


ship(__name__)
