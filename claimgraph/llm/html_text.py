"""Main text of web pages, with site templates removed.

Two passes parse the pages. The first hashes every block element's subtree, from the leaves up, and counts in Spark on how
many pages of a host each occurs, pages with the same main text counting once; a host's templates are the subtrees on many
of its pages. They are gathered as one short array a host, bounded by the share of pages that each needs, and joined to
the pages, those of large hosts dealt over several parts. The second pass deletes the templates first. Rules take what
they leave, since some of a page's frame differs from page to page and small hosts have no templates: elements that are
never main text (menus, footers, scripts and so on, by element, role or class) go, and the blocks left are joined, those
of the articles, or of the body where the articles left have less than a quarter of its text. Counts tell how many
characters each of them removed. A class or id marks an element by a token's first word, inside an article only by a whole
token. It drops no element that is or holds an article, but for articles that are reader comments. A form, dialog or role
drops its element neither then nor if it holds more than half of the page's text and no article is beside it.

A subtree is also counted by a looser key, without link targets, texts of links, digits and repetitions, if nearly all its
text is in links: that is how menus with other links on each page recur. A page of nothing but
links keeps them.

What recurs inside articles is content as a rule, copies of an article above all: there a subtree is a template only if
over half of the host's pages have it.

Defined cases: null and empty html give an empty text; pages without markup give their text; broken markup is read as
browsers read it in the main (unclosed blocks end where their parent ends, a quote that is never closed does not count, a
tag that never ends is text), in time linear in its length; null urls are one host; repeated rows are
pages each; a null id stays null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, partitions

#: A template is on at least so many pages of its host, and on at least such a share of them, outside and inside articles.
LEAST_PAGES, SHARE, SHARE_INSIDE = 5, 0.05, 0.5
_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/<>]*))")
_COMMENT_END = re.compile("--!?>")
_STOP = re.compile("[>\"']")
#: Open elements at most; what is nested deeper belongs to the last of them, as in browsers.
DEPTH = 512
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes".split())
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre search section select summary table tbody td tfoot th thead tr ul".split()
)
_LONE = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NEVER = frozenset("nav footer aside button select menu head search".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner sidebar sidenav nav navbar navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent notice popup modal overlay newsletter subscribe signup share sharing social related recommended comment comments disqus replies".split()
)
_REPLIES = frozenset("comment comments disqus replies".split())
#: What may stand beside a mark in a class or id inside an article; other words make it content's own name.
_BESIDE = frozenset("area articles bar block box button buttons container content form icon icons inner item items link links list module news panel posts section stories text widget wrap wrapper".split())
#: Elements and roles that hold a whole page now and then.
_AROUND = frozenset("form dialog".split())
_DIGITS = re.compile("[0-9]+")
#: What an opening tag closes first, if it is open within the innermost of its bounds.
_CLOSES = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"), "body": ("head", "html")}
_ENDS_P = _BLOCKS - {"body", "head", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup"}


class _Open:
    __slots__ = ("blocks", "dropped", "last", "loose", "main", "marks", "parts", "tag")

    def __init__(self, tag: str, head: str, blocks: int, dropped: bool, main: bool, marks: tuple[int, ...]):
        self.tag, self.parts, self.blocks, self.dropped, self.main, self.marks = tag, [head], blocks, dropped, main, marks
        self.loose, self.last = [tag], None  # the same without what differs from page to page, and the child before


class _Ends:
    """Where tags end, quotes observed; linear over a page, however broken: no quote is followed in vain twice."""

    def __init__(self, source: str):
        self.source, self.dead, self.last = source, set(), source.rfind(">")
        self.clear = (0, -1)  # a stretch without stops, and the stop behind it

    def _stop(self, at: int) -> int:
        if not self.clear[0] <= at <= self.clear[1]:
            m = _STOP.search(self.source, at)
            self.clear = (at, m.start() if m else len(self.source))
        return self.clear[1]

    def tag(self, at: int) -> int:
        """The place behind the end of an opening tag from ``at``; a quote that is never closed does not count; -1 if none."""
        seen, here = [], at
        while here <= self.last:
            k = self._stop(here)
            if self.source[k] == ">":
                return k + 1
            if k in self.dead:
                break
            seen.append(k)
            end = self.source.find(self.source[k], k + 1)
            if end < 0:
                break
            here = end + 1
        self.dead.update(seen)
        return self.plain(at)

    def plain(self, at: int) -> int:
        """The place behind the next > from ``at``, or -1."""
        return self.source.index(">", at) + 1 if at <= self.last else -1


def _marks(token: str, inside: bool) -> bool:
    """Whether a class or id token marks what is no main text: by its first word, inside an article by all its words."""
    words = re.split(r"[^a-z0-9]+", token)
    return words[0] in _MARKS and (not inside or all(x in _MARKS or x in _BESIDE or not x for x in words))


def _never_main(tag: str, attributes: str, inside: bool) -> tuple[bool, str]:
    """Whether the element is never main text; and ``mark`` if a class or id says so unless it is or holds an article, ``around`` if its kind does unless it is or holds the main text."""
    if tag in _NEVER or tag == "header" and not inside:
        return True, ""
    found = "around" if tag in _AROUND else ""
    if "=" not in attributes:
        return False, found
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() == "role":
            if not _ROLES.isdisjoint(re.split(r"[^a-z0-9]+", value.lower())) and tag not in ("html", "body"):
                found = found or "around"
        elif tag not in ("html", "body", "main"):
            tokens = value.lower().strip("\"'").split()
            if tag == "article" and any(not _REPLIES.isdisjoint(re.split(r"[^a-z0-9]", t)[:1]) for t in tokens):
                return True, ""
            if any(_marks(t, inside) for t in tokens):
                found = "mark"
    return False, found


def parse(source: str) -> tuple[list[tuple[str, bool, bool, int]], list[tuple[int, int, int, bool]]]:
    """Blocks (text, dropped, in an article, characters outside links) and subtrees (key, first block, end block, in an article) of a page.

    A subtree's key hashes its tags, its text and its subtrees' keys, from the leaves up; scripts and styles do not count.
    Outside articles it has a second, looser key, of what does not differ from page to page: no attributes, no text in
    links, no digits, and equal subtrees in a row once, so that menus of other links and lengths hash alike.
    """
    blocks: list[tuple[str, bool, bool, tuple[int, ...], int]] = []
    trees: list[tuple[int, int, int, bool]] = []
    stack = [_Open("", "", 0, False, False, ())]
    open_: Counter[str] = Counter()
    holds: list[bool] = []  # of each marked element, whether it is or holds a kept article
    around: list[bool] = []  # and whether half of the page's text keeps it as well
    text: list[str] = []
    link, linked = False, 0

    def add(piece: str) -> None:
        nonlocal linked
        text.append(piece)
        own = stack[-1]
        own.parts.append(piece)
        if link:
            linked += len(piece)
        elif not piece.isspace():
            own.loose.append(_DIGITS.sub("#", piece))
            own.last = None

    def flush() -> None:
        nonlocal link, linked
        if text:
            whole = " ".join(entities.unescape("".join(text)).split())
            if whole:
                blocks.append((whole, stack[-1].dropped, stack[-1].main, stack[-1].marks, max(0, len(whole) - linked)))
            text.clear()
        link, linked = False, 0

    def close(depth: int) -> None:
        flush()
        while len(stack) > depth:
            x = stack.pop()
            open_[x.tag] -= 1
            key, loose = _key("".join(x.parts)), _key("\0".join(x.loose))
            up = stack[-1]
            up.parts.append(f"\0{key}\0")
            if up.last != loose:
                up.loose.append(str(loose))
                up.last = loose
            if x.tag not in ("html", "body", "article", "main") and len(blocks) > x.blocks:
                trees.append((key, x.blocks, len(blocks), x.main))
                # a key of tags alone, without a link, would be that of any text
                if not x.main and x.loose != [x.tag] and all(b[4] <= len(b[0]) // 4 for b in blocks[x.blocks :]):
                    trees.append((loose, x.blocks, len(blocks), False))

    ends, at, done = _Ends(source), 0, 0
    while (m := _OPEN.search(source, at)) is not None:
        start, at = m.start(), m.end()
        if m[1]:
            end = _COMMENT_END.search(source, at)
            end = end.end() if end else len(source)
        elif m[2]:
            end = ends.plain(at)
            end = end if end > 0 else len(source)
        else:
            end = ends.plain(at) if m[3] else ends.tag(at)
            if end < 0:
                continue  # no tag: text
        if start > done:
            add(source[done:start])
        at = done = end
        tag = m[4].lower() if m[4] else ""
        if m[3]:
            if tag in _BLOCKS:
                if not open_[tag]:
                    flush()
                    continue
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        close(depth)
                        break
            elif tag == "br":
                add(" ")
            elif tag == "a":
                link = False
            continue
        if not tag:
            continue
        if tag in _RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(source, at)
            at = done = end.end() if end else len(source)
            continue
        if tag in ("br", "img", "wbr", "input"):
            if tag != "wbr":
                add(" ")
            continue
        if tag not in _BLOCKS:
            stack[-1].parts.append(source[start:end])
            if tag == "a":
                link = True
                if stack[-1].last != "a":
                    stack[-1].loose.append("a")
                    stack[-1].last = "a"
            continue
        flush()
        if tag in _ENDS_P and open_["p"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close(depth)
                    break
                if stack[depth].tag in ("button", "td", "th", "caption"):
                    break
        if tag in _CLOSES:
            own, bounds = (x.split() for x in _CLOSES[tag])
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in bounds:
                    break
                if stack[depth].tag in own:
                    close(depth)
                    break
        if tag in _LONE or len(stack) > DEPTH:
            continue
        up, attributes = stack[-1], source[m.end() : end - 1]
        never, marked = _never_main(tag, attributes, up.main)
        dropped, main, marks = up.dropped or never, tag in ("article", "main") or 'role="main"' in attributes, up.marks
        if marked:
            marks = (*marks, len(holds))
            holds.append(False)
            around.append(marked == "around")
        if main and not dropped:
            for k in marks:
                holds[k] = True
        stack.append(_Open(tag, source[start:end], len(blocks), dropped, up.main or main, marks))
        open_[tag] += 1
    if done < len(source):
        add(source[done:])
    close(1)
    flush()
    # a form or dialog round most of the page's text holds the main text, if no article stands beside it
    if any(around) and not any(main and not dropped and not marks for _, dropped, main, marks, _ in blocks):
        plain = Counter()
        for _, dropped, _, marks, n in blocks:
            if not dropped and all(holds[k] or around[k] for k in marks):
                plain.update(dict.fromkeys((None, *marks), n))
        for k, possible in enumerate(around):
            holds[k] |= possible and 2 * plain[k] > plain[None]
    return [(whole, dropped or not all(holds[k] for k in marks), main, n) for whole, dropped, main, marks, n in blocks], trees


def _key(piece: str) -> int:
    return xxhash.xxh3_64_intdigest(piece.encode("utf-8", "surrogatepass")) - (1 << 63)


def subtree_counts(pages: DataFrame) -> DataFrame:
    """(host, key, inside, article) rows, each once a page, of block subtrees that hold text; key null is the page itself.

    ``article`` is a hash of the main text, so that copies of one article can count once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys, inside, articles = [], [], [], []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                blocks, trees = parse(html or "")
                article = _key("\n".join(x[0] for x in blocks if x[2] or not x[1]))
                own = {(key, main) for key, _, _, main in trees}
                hosts += [host] * (len(own) + 1)
                keys += [None, *(k for k, _ in own)]
                inside += [False, *(m for _, m in own)]
                articles += [article] * (len(own) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(inside), pa.array(articles, pa.int64())], names=["host", "key", "inside", "article"])

    return pages.select("host", "html").mapInArrow(run, "host string, key long, inside boolean, article long")


def templates(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, keys): each host's template subtrees; and (host, pages). A page has a bounded number of blocks, so shares bound the arrays."""
    counts = cut(subtree_counts(pages).groupBy("host", "key", "inside").agg(F.count_distinct("article").alias("n")).filter((F.col("n") >= LEAST_PAGES) | F.col("key").isNull()), "subtrees")
    total = cut(counts.filter("key is null").select("host", F.col("n").alias("pages")), "hosts")
    common = counts.filter("key is not null").join(total, "host")
    common = common.filter(F.col("n") >= F.col("pages") * F.when(F.col("inside"), SHARE_INSIDE).otherwise(SHARE))
    return cut(common.groupBy("host").agg(F.collect_set("key").alias("keys")), "templates"), total


_COUNTS = ("n_chars", "n_templates", "template_chars", "rule_chars", "outside_chars")


def main_text(html: str, known: set[int]) -> tuple[str, int, int, int, int]:
    """The text; the template subtrees deleted; the characters that went with them, by rules, and for being outside the articles."""
    blocks, trees = parse(html)
    gone, n = set(), 0
    for key, i, j, _ in trees if known else ():
        if key in known:
            gone.update(range(i, j))
            n += 1
    left = [x for k, x in enumerate(blocks) if k not in gone]
    if not any(x[3] for x in blocks):  # a page of nothing but links is no menu
        left, n = blocks, 0
    own = [x for x in left if not x[1]]
    main, plain = [x for x in own if x[2]], sum(x[3] for x in own)
    if 4 * sum(x[3] for x in main) < plain or not main:  # teasers beside a text that is in no article
        main = own
    chars = lambda rows: sum(len(x[0]) for x in rows)
    return "\n\n".join(x[0] for x in main), n, chars(blocks) - chars(left), chars(left) - chars(own), chars(own) - chars(main)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_templates (subtrees deleted as templates), and the characters that went with templates, by rules and for being outside the articles."""
    url = F.col(url_col).cast("string")
    host = F.regexp_replace(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), r"\.$", "")
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), F.coalesce(host, F.lit("")).alias("host"), F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for html, keys in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                text, *own = main_text(html or "", set(keys or ()))
                texts.append(text)
                counts.append((len(text), *own))
            numbers = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)] if counts else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), *numbers], names=["page_id", "url", "text", *_COUNTS])

    found, total = templates(pages)
    # hosts with more pages than a partition's share, fewer than there are partitions, are dealt over parts in proportion
    every, share = total.agg(F.sum("pages")).first()[0] or 0, partitions(pages.sparkSession)
    hot = [(r["host"], -(-r["pages"] * share // every)) for r in total.filter(F.col("pages") * share > every).collect()]
    if hot:
        hot = F.broadcast(pages.sparkSession.createDataFrame(hot, "host string, parts int"))
        part = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
        # written, so that Spark knows its size and moves no page if it is small
        found = cut(found.join(hot, "host", "left").withColumn("part", F.explode(part)).drop("parts"), "dealt")
        pages = pages.join(hot, "host", "left").withColumn("part", F.pmod(F.hash("page_id", "url"), F.coalesce("parts", F.lit(1)))).drop("parts")
    out = pages.join(found, ["host", "part"] if hot else "host", "left").select("page_id", "url", "html", "keys")
    return out.mapInArrow(run, "page_id long, url string, text string, " + ", ".join(f"{c} long" for c in _COUNTS))
