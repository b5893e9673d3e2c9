"""Main text of web pages: the article that markup marks or else all text, without what repeats across the pages of a host.

A page is parted into blocks. Blocks in elements that are never part of an article (by tag, role, class, id or hidden state) go;
if the page marks its article (``article``, else ``main``, with at least as much text as is beside it), its blocks are to be
chosen from, on other pages all that are left; where all blocks are in elements that are never part of an article, such as a
form around the page, the choice is among these.

Each text of a host's pages is a token stream. The suffixes of these streams are grouped by their first ``RUN`` tokens, which
are the intervals of the host's suffix array with a common prefix of that length. Where nothing is marked, a group with two
distinct pages is a repeated run, and blocks that repeated runs cover go. Inside marked articles the mark speaks for a block,
and quotes and copies repeat there, too. So a run is boilerplate there if one in ``ONE_IN`` of the host's distinct articles has
it, ``LEAST`` at least, not counting articles more than half of which such runs cover, as these are copies of each other. Only
blocks covered to the last token go, and no article goes as a whole.
"""

from __future__ import annotations

import html
import re
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm import text as T
from kerbside.llm.store import materialize

RUN = 6  # tokens in a repeated run, at least
COVERED = 80  # per cent of a block's tokens in repeated runs from which on it is boilerplate
ONE_IN = 3  # of a host's distinct articles that have a run if it is boilerplate inside articles
LEAST = 3  # such articles, at least
SLICE = 4 << 20  # runs sent to all executors at once
SLICES = 8  # times that the texts are read for this, at most

# Elements without text of a page's own, elements that part blocks, and elements without an end tag, by the HTML standard.
RAW = "script style noscript template textarea title iframe svg canvas object select annotation annotation-xml audio video".split()
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody
    td tfoot th thead tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Elements, roles and parts of class names and ids that mark what is not the article.
OUTSIDE_TAGS = frozenset("head nav footer aside form menu dialog button search".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
OUTSIDE_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner cookie cookies
    consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social
    related recommended recommendations sidebar aside menu menus nav navbar navigation breadcrumb breadcrumbs footer foot
    masthead comment comments commentlist respond disqus widget widgets pagination pager toolbar skip""".split()
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?:[^>\"'/]|/(?!>)|\"[^\"]*\"|'[^']*')*+(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<option(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>[^<]*"  # its end tag may be left out
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LAYOUT = frozenset("with without has have no not".split())  # beside a word of OUTSIDE_NAMES: what a page has, no name of the part
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def _outside(tag: str, attributes: str, in_article: bool) -> str:
    """``outside`` for what is never part of an article, ``named`` for what only its class or id tells."""
    if tag in OUTSIDE_TAGS or (tag == "header" and not in_article):
        return "outside"
    if not attributes or tag in ("html", "body"):
        return ""
    named = ""
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            return "outside"
        if name == "role" and value.lower() in OUTSIDE_ROLES:
            return "outside"
        if name in ("class", "id"):
            for word in value.split():
                parts = {p.lower() for p in NAME.findall(word)}
                if not parts & LAYOUT and (parts & OUTSIDE_NAMES or ("header" in parts and not in_article)):
                    named = "named"
    return named


def blocks(page: str | None) -> list[tuple[str, str]]:
    """Blocks with text, in order, and where each is: ``article``, ``main``, ``outside`` or ``body``."""
    found: list[tuple[str, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, str]] = []  # open elements and what they mark
    depth = {"outside": 0, "named": 0, "held": 0, "article": 0, "main": 0, "": 0}

    def close_block():
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            found.append((text, next((kind for kind in ("outside", "held", "named", "article", "main") if depth[kind]), "body")))

    at = 0
    page = page or ""
    for m in TOKEN.finditer(page):
        if m.start() > at:
            text = page[at : m.start()]
            parts.append(html.unescape(text) if "&" in text else text)
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            close_block()
        elif tag == "br":
            parts.append(" ")
        if m["end"]:
            if any(t == tag for t, _ in stack):
                if tag not in BLOCKS and any(t in BLOCKS for t, _ in stack[max(i for i, (t, _) in enumerate(stack) if t == tag) :]):
                    continue  # an inline end tag does not close blocks
                while True:
                    t, mark = stack.pop()
                    depth[mark] -= 1
                    if t == tag:
                        break
        elif tag not in VOID and not m["attributes"].endswith("/"):
            if tag == "body":
                stack.clear()
                depth = dict.fromkeys(depth, 0)
            inside = bool(depth["article"] or depth["main"] or depth["held"])
            mark = _outside(tag, m["attributes"], inside)
            if mark == "named" and inside:
                mark = "outside"
            elif not mark and tag in ("article", "main"):
                mark = "held" if depth["named"] else tag
            if not mark and tag not in BLOCKS and not (depth["outside"] or depth["named"]):
                continue
            stack.append((tag, mark))
            depth[mark] += 1
    if at < len(page):
        text = page[at:]
        parts.append(html.unescape(text) if "&" in text else text)
    close_block()
    # An element named as outside that holds the article is none: no article elsewhere, and most of the text in this one.
    size = {kind: sum(len(t) for t, k in found if k == kind) for kind in ("held", "article", "main", "body")}
    held = "article" if size["held"] > size["body"] and not size["article"] + size["main"] else "outside"
    return [(t, {"held": held, "named": "outside"}.get(kind, kind)) for t, kind in found]


def _mark(found: list[tuple[str, str]]) -> str | None:
    """The mark that tells a page's text: one with less text than is beside it, such as teasers in ``article``, tells nothing."""
    size = {kind: sum(len(t) for t, k in found if k == kind) for kind in ("article", "main", "body")}
    if size["article"]:
        return "article" if size["article"] >= size["main"] + size["body"] else None
    return "main" if size["main"] and size["main"] >= size["body"] else None


def _runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' runs of ``RUN`` tokens, one for each start, and len + 1 offsets."""
    h, doc = T.word_hashes(texts, lower=True)
    grams, of = T.shingles(h, doc, RUN)
    return grams.view(np.int64), np.searchsorted(of, np.arange(len(texts) + 1))


def _inside(starts: np.ndarray, n: int) -> np.ndarray:
    """n + 1 running totals of the tokens that runs at ``starts`` cover."""
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + RUN, -1)
    return np.concatenate([[0], np.cumsum(np.cumsum(cover[:n]) > 0)])


def _parsed(batches):
    """A row a page: the blocks to choose from, a line each, are they ``open`` (not marked); and the runs of the tokens beside the article."""
    for piece in T.pieces(batches, "html", limit=4 << 20):
        texts, opened, streams = [], [], []
        for page in piece.column("html").to_pylist():
            found = blocks(page)
            kinds = {kind for _, kind in found}
            article = _mark(found)
            opened.append(bool(found) and not article)
            if opened[-1]:
                chosen = [t for t, kind in found if kind != "outside" or kinds == {"outside"}]
            else:
                chosen = [t for t, kind in found if kind == article]
            texts.append("\n".join(chosen))
            # Of a page without an article the stream is what is to be chosen from; elsewhere all beside the article.
            streams.append(texts[-1] if opened[-1] else "\n".join(t for t, kind in found if kind != article))
        grams, begin = _runs(pa.array(streams, pa.string()))
        runs = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(grams))
        yield pa.RecordBatch.from_arrays(
            [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()), pa.array(opened), runs], ["page_id", "url", "text", "open", "runs"]
        )


def _chosen(batches):
    """Text of pages from the blocks that repeated runs do not cover."""
    for batch in batches:
        texts = []
        for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist(), strict=True):
            found = text.split("\n")
            ends = np.cumsum([0, *(t.count(" ") + 1 for t in found)])
            inside = _inside(np.array(starts or [], np.int64), ends[-1])
            texts.append("\n".join(t for t, a, b in zip(found, ends[:-1], ends[1:], strict=True) if 100 * (inside[b] - inside[a]) < COVERED * (b - a)))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _squeezed(batches):
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [squeeze.compress(t.encode()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("article"), pa.array(packed, pa.binary())], ["host", "article", "packed"])


def _by_host(batches):
    """Rows in the order of host in parts, and may the first and last host of a part go on in others; the rest are whole."""
    held, begun = None, True
    for piece in T.pieces(batches, "packed"):
        held = pa.concat_batches([held, piece]) if held else piece
        hosts = held.column("host").dictionary_encode().indices.to_numpy()
        last = int(np.argmax(hosts == hosts[-1]))
        if last:
            yield held.slice(0, last), begun, False
            held, begun = held.slice(last), False
        elif held.nbytes > T.PIECE:
            yield held, begun, True
            held, begun = None, True
    if held:
        yield held, begun, True


def _often_here(batches):
    """Runs that may be in one in ``ONE_IN`` of a host's articles, from rows in the order of host and article.

    The counts of a host that is whole in a part are final. Of one that goes on in other parts, two neighbours share one
    article at most, so the articles of p parts sum up to less than p more than the host has: a run that one in ``ONE_IN``
    of all has is as frequent in a part.
    """
    squeeze = zstandard.ZstdDecompressor()
    for part, begun, goes_on in _by_host(batches):
        names = part.column("host").dictionary_encode()
        host, article = names.indices.to_numpy(), part.column("article").to_numpy()
        new = np.ones(len(host), bool)
        new[1:] = (host[1:] != host[:-1]) | (article[1:] != article[:-1])
        packed = part.column("packed").take(pa.array(np.flatnonzero(new)))
        grams, begin = _runs(pa.array([squeeze.decompress(x).decode() for x in packed.to_pylist()], pa.string()))
        grams, of = T.distinct(grams, np.repeat(np.arange(len(packed)), np.diff(begin)))
        articles = np.bincount(host[new])
        needed = np.maximum(LEAST, -(-articles // ONE_IN))
        for edge in host[:1][[begun]], host[-1:][[goes_on]]:
            needed[edge] = -(-articles[edge] // ONE_IN)
        of = host[new][of]
        order = np.lexsort((grams, of))
        grams, of = grams[order], of[order]
        first = np.ones(len(grams), bool)
        first[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
        first = np.flatnonzero(first)
        often = first[np.diff(np.r_[first, len(grams)]) >= needed[of[first]]]
        yield pa.RecordBatch.from_arrays([names.dictionary.take(pa.array(of[often])), pa.array(grams[often])], ["host", "run"])


def _having(batches):
    """Pieces with, for each text, its runs, the starts of those that are in ``often``, and its number of tokens (0: no such run)."""
    for piece in T.pieces(batches):
        if piece.column("often").null_count == piece.num_rows:
            yield piece, []
            continue
        grams, begin = _runs(piece.column("text"))
        found = []
        for a, b, often in zip(begin[:-1], begin[1:], piece.column("often"), strict=True):
            starts = np.flatnonzero(np.isin(grams[a:b], often.values.to_numpy())) if often.is_valid else []
            found.append((grams[a:b], starts, b - a + RUN - 1 if len(starts) else 0))
        yield piece, found


def _seen(batches, copies: bool):
    """The distinct runs in ``often`` of each article; without ``copies`` not of those more than half covered by them."""
    for piece, found in _having(batches):
        runs = [np.unique(own[starts]) if n and (copies or 2 * _inside(starts, n)[-1] <= n) else own[:0] for own, starts, n in found]
        if runs:
            row = pa.array(np.repeat(np.arange(len(runs)), [len(r) for r in runs]))
            keys = [piece.column(x).take(row) for x in ("host", "article", "page")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(np.concatenate(runs))], ["host", "article", "page", "run"])


def _unrepeated(batches):
    """Articles without the blocks that runs in ``often`` cover to the last token."""
    for piece, found in _having(batches):
        texts = piece.column("text")
        if any(n for _, _, n in found):
            texts = texts.to_pylist()
            for i, (_, starts, n) in enumerate(found):
                if n:
                    parts = texts[i].split("\n")
                    ends = np.cumsum([0, *(t.count(" ") + 1 for t in parts)])
                    inside = _inside(starts, n)
                    kept = [t for t, a, b in zip(parts, ends[:-1], ends[1:], strict=True) if inside[b] - inside[a] < b - a]
                    texts[i] = "\n".join(kept or parts)
            texts = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays([piece.column("page_id"), piece.column("url"), texts], ["page_id", "url", "text"])


def _with_often(articles: DataFrame, often: DataFrame, how: str) -> DataFrame:
    """Articles with the runs of their host. The runs go to the texts in slices, as a shuffle of the texts takes their size
    on disk; too many runs for that are left to a plain join."""
    slices = (often.agg(F.sum(F.size("often"))).first()[0] or 0) // SLICE + 1
    if slices > SLICES:
        return articles.join(often, "host", how)
    of = F.pmod(F.hash("host"), F.lit(slices))
    return reduce(DataFrame.union, (articles.where(of == i).join(F.broadcast(often.where(of == i)), "host", how) for i in range(slices)))


def _boilerplate(articles: DataFrame) -> DataFrame:
    """``often``, the runs that are boilerplate inside articles, of each host with such runs."""
    least = F.greatest(F.lit(LEAST), F.ceil(F.countDistinct("article") / ONE_IN)).alias("least")
    hosts = materialize(articles.groupBy("host").agg(least), "hosts")
    laid = articles.select("host", "article", "text").mapInArrow(_squeezed, "host string, article long, packed binary")
    laid = laid.repartitionByRange("host", "article").sortWithinPartitions("host", "article")
    runs = laid.mapInArrow(_often_here, "host string, run long").distinct()
    # A candidate's articles are counted over the whole host, then those of them that are no copies.
    for copies in (True, False):
        often = materialize(runs.groupBy("host").agg(F.collect_list("run").alias("often")), "often")
        seen = _with_often(articles, often, "inner").mapInArrow(lambda batches, copies=copies: _seen(batches, copies), "host string, article long, page long, run long")
        counted = seen.groupBy("host", "run").agg(F.countDistinct("article").alias("articles"), F.countDistinct("page").alias("pages"))
        runs = counted.join(hosts, "host").where("articles >= least AND pages >= least").select("host", "run")
    return materialize(runs.groupBy("host").agg(F.collect_list("run").alias("often")), "boilerplate")


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``pages(page_id, url, html)``.

    Character references are decoded, white space in a block becomes one space, blocks are joined by a line feed. Null
    and empty html give an empty text. Pages with the same id (rows without one count each for itself) are one page when
    repeats across distinct pages are sought; pages without a host form a host of their own. Repeated rows come out as
    often as they came in; other columns are not looked at; an empty table gives no rows.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    parsed = pages.mapInArrow(_parsed, "page_id long, url string, text string, open boolean, runs array<long>")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    row = F.monotonically_increasing_id()
    parsed = materialize(parsed.select("*", host.alias("host"), row.alias("row"), F.xxhash64("text").alias("article")), "pages", "zstd")
    parsed = parsed.withColumn("page", F.coalesce("page_id", -1 - F.col("row")))

    suffixes = parsed.select("row", "page", "host", "open", F.posexplode("runs").alias("start", "run"))
    repeated = suffixes.groupBy("host", "run").agg(F.min("page").alias("low"), F.max("page").alias("high")).where("low <> high").select("host", "run")
    covered = materialize(suffixes.where("open").select("row", "host", "start", "run"), "suffixes").join(materialize(repeated, "repeated"), ["host", "run"])
    covered = covered.groupBy(F.col("row").alias("of")).agg(F.collect_list("start").alias("starts"))
    unmarked = parsed.where("open").select("row", "page_id", "url", "text")
    chosen = unmarked.join(covered, F.col("row") == F.col("of"), "left").select("page_id", "url", "text", "starts")

    articles = parsed.where("NOT open").select("page_id", "url", "host", "article", "page", "text")
    marked = _with_often(articles, _boilerplate(articles.where("text <> ''")), "left").select("page_id", "url", "text", "often")
    found = "page_id long, url string, text string"
    texts = marked.mapInArrow(_unrepeated, found).union(chosen.mapInArrow(_chosen, found))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
