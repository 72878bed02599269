"""Main text of web pages: names of boilerplate, and a style tree of each host with entropy-based importance."""

from __future__ import annotations

import html as entities
import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tablelearn.plans.lineage import checkpointed

from .urls import host_of

#: Branches and single texts of lower importance go.
MIN_IMPORTANCE = 0.2
#: Share of the importance that the content keeps with each kind of child.
DECAY = 0.9
#: Up to so many branches to remove, their table is sent to all tasks; beyond, it is joined by a shuffle.
BROADCAST_BRANCHES = 20_000

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
# Elements of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "thead": {"caption"}, "tfoot": {"tr", "td", "th", "tbody"},
}
# A text in one of these means little without what stands around it, so it is not judged by itself.
_PARTS = frozenset("h1 h2 h3 h4 h5 h6 li dt dd td th caption pre figcaption blockquote".split())
_FENCE = frozenset("ul ol dl table tr select".split())
# Boilerplate by element, role and parts of class or id.
_DROP_TAGS = frozenset(
    "audio applet aside button canvas datalist dialog embed footer form head iframe input map math menu nav noembed noframes noscript object script search select "
    "style svg template textarea title video".split())
_DROP_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
_DROP_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr "
    "login menu modal nav navbar navigation newsletter notice notices notification outbrain pager pagination popup promo promos promoted promotion recommended "
    "related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola toolbar topbar widget widgets".split())
_PAGE_ONLY = frozenset("header masthead".split())
_REPLIES = frozenset("comment comments disqus replies reply respond".split())


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), entities.unescape(a or b or c))
    return found


class Page:
    """One pass over the markup. ``blocks``: (text, inside article or main, plain, branches, part of a heading, list, table or
    the like); a branch is the hash of the tags, classes and ids from the root to an element, the innermost last. ``shapes``: branch -> tags of its children, for the elements that
    stand on the way to a block."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, bool, bool, list[int], bool]] = []
        self.shapes: dict[int, list[str]] = {}
        self._text: list[str] = []
        self._stack = [("", 0, False, False, True, (), 0)]  # tag, branch, dropped, inside, plain, named, article
        self._named: list[bool] = []  # of each element outside articles that goes by its names: whether they tell of replies
        self._articles = 0
        self._held: list[tuple[tuple[int, ...], int]] = []  # of each block: the named elements and the article around it
        self._read(source)
        self._give_back()

    def _give_back(self) -> None:
        """Names drop no element that holds the page's article, which is the one with the most text, or without an article
        most of the page's text. A page that would lose all its text keeps it."""
        size, back = [len(b[0]) for b in self.blocks], set()
        articles: dict[tuple[tuple[int, ...], int], int] = {}
        for n, key in zip(size, self._held, strict=True):
            if key[1]:
                articles[key] = articles.get(key, 0) + n
        if articles:
            back.update(max(articles, key=lambda k: (not any(self._named[e] for e in k[0]), articles[k]))[0])
        else:
            below = [0] * len(self._named)
            for n, (named, _) in zip(size, self._held, strict=True):
                for e in named:
                    below[e] += n
            total = sum(size)
            back.update(e for e, n in enumerate(below) if 2 * n > total)
        kept = [b for b, (named, _) in zip(self.blocks, self._held, strict=True) if back.issuperset(named)]
        self.blocks = kept or self.blocks

    def _read(self, source: str) -> None:
        at = 0
        while True:
            found = _TOKEN.search(source, at)
            self._add(source[at:found.start() if found else len(source)])
            if not found:
                break
            at = found.end()
            slash, tag, raw = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
            if not tag:
                continue
            tag = tag.lower()
            if slash:
                self._end(tag)
            else:
                self._start(tag, raw or "")
                if tag in _RAW and not (raw or "").endswith("/"):
                    close = re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.I).search(source, at)
                    at = close.start() if close else len(source)
        self._flush()

    def _add(self, text: str) -> None:
        if text and not self._stack[-1][2]:
            self._text.append(text)

    def _flush(self) -> None:
        if self._text:
            text = " ".join(entities.unescape("".join(self._text)).split())
            self._text = []
            if text:
                _, _, _, inside, plain, named, article = self._stack[-1]
                self._held.append((named, article))
                part = any(e[0] in _PARTS for e in self._stack)
                self.blocks.append((text, inside, plain, list(dict.fromkeys(e[1] for e in self._stack[1:])), part))

    def _start(self, tag: str, raw: str) -> None:
        if tag in _BLOCK:
            self._flush()
            self._close({"p"}, _FENCE | {"td", "th", "button"})
        if tag in _CLOSES:
            self._close(_CLOSES[tag], _FENCE - {"tr"} if tag in ("tr", "tbody", "tfoot", "thead") else _FENCE)
        if tag == "br":
            self._add(" ")
        if tag in _VOID:
            return
        values = _attributes(raw) if "=" in raw or "hidden" in raw else {}
        own = f"{values.get('class', '')}#{values.get('id', '')}#{values.get('role', '')}"
        _, parent, dropped, inside, plain, named, article = self._stack[-1]
        branch = xxhash.xxh3_64_intdigest(f"{parent}>{tag}.{own}".encode("utf-8", "surrogatepass")) - (1 << 63)
        main = tag in ("article", "main") or values.get("role", "").lower() == "main" or values.get("itemprop", "") == "articleBody"
        if not dropped:
            self.shapes.setdefault(parent, []).append(tag)
        dropped = dropped or self._boilerplate(tag, values, inside, main)
        if not dropped and not main and tag not in ("html", "body") and (names := self._names(values) & (_DROP_NAMES if inside else _DROP_NAMES | _PAGE_ONLY)):
            if inside:
                dropped = True
            else:
                self._named.append(bool(names & _REPLIES))
                named = (*named, len(self._named) - 1)
        if main and not inside:
            self._articles += 1
            article = self._articles
        self._stack.append((tag, branch, dropped, inside or main, main or (plain and own == "##"), named, article))

    @staticmethod
    def _names(values) -> set[str]:
        return {n.lower() for n in _NAME.findall(values.get("class", "") + " " + values.get("id", ""))} if values else set()

    @staticmethod
    def _boilerplate(tag: str, values: dict[str, str], inside: bool, main: bool) -> bool:
        if tag in _DROP_TAGS or (tag == "header" and not inside):
            return True
        if not values:
            return False
        if main:
            return bool(Page._names(values) & _REPLIES)
        if tag in ("html", "body"):
            return False
        style = values.get("style", "").replace(" ", "").lower()
        if "hidden" in values or values.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style:
            return True
        return values.get("role", "").lower() in _DROP_ROLES and not (inside and values.get("role", "").lower() == "banner")

    def _close(self, tags, fence) -> None:
        """End the open elements down to the outermost of ``tags`` above the next fence."""
        at = None
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k][0] in tags:
                at = k
            elif self._stack[k][0] in fence:
                break
        if at is not None:
            self._flush()
            del self._stack[at:]

    def _end(self, tag: str) -> None:
        if tag in _BLOCK:
            self._flush()
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k][0] == tag:
                del self._stack[k:]
                break


def importance(features: DataFrame) -> DataFrame:
    """(host, branch, importance, pages) from ``features`` (host, branch, kind, feature, pages): on how many different
    pages of the host a branch has a text (kind 0) or a sequence of children (kind 1); kind 2 counts its pages.

    A text on n of a branch's m pages has the entropy log n / log m, and the content's importance is one less the mean
    entropy of its texts. The importance of the presentation is the entropy of the sequences of children, to the base m.
    The more kinds of children, the more the presentation weighs.
    """
    return judged(branch_sums(features, "host", "branch"))


def branch_sums(features: DataFrame, *keys) -> DataFrame:
    """What the importance of a branch is made of; all but ``m``, of which the greatest counts, add up."""
    total = F.max(F.when(F.col("kind") == 2, F.col("pages")))
    n, log_n = F.col("pages"), F.log(F.col("pages").cast("double"))

    def of(kind, value):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, value)), F.lit(0.0))

    return features.groupBy(*keys).agg(
        total.alias("m"), of(0, n * log_n).alias("text_log"), of(0, n.cast("double")).alias("texts"), of(1, n * log_n).alias("shape_log"),
        of(1, n.cast("double")).alias("shapes"), F.sum((F.col("kind") == 1).cast("long")).alias("kinds"))


def judged(sums: DataFrame) -> DataFrame:
    """(host, branch, importance, pages) of the branches that two or more pages have."""
    log_m = F.log(F.col("m").cast("double"))
    content = 1 - F.when(F.col("texts") > 0, F.col("text_log") / F.col("texts") / log_m).otherwise(0.0)
    shape = F.when(F.col("shapes") > 0, (F.log("shapes") - F.col("shape_log") / F.col("shapes")) / log_m).otherwise(0.0)
    keep = F.pow(F.lit(DECAY), F.least(F.col("kinds"), F.lit(10)) - 1)
    return sums.where("m > 1").select("host", "branch", (keep * content + (1 - keep) * F.least(shape, F.lit(1.0))).alias("importance"), F.col("m").alias("pages"))


def smoothed(found, m):
    """Importance on ``m`` pages with one page more on which nothing is shared, so that few pages prove little: what all of
    2, 3, 4 or 7 pages share has 0.37, 0.21, 0.14 or 0.06, and on many pages nearly 0."""
    return 1 - (1 - found) * F.log(m.cast("double")) / F.log(m.cast("double") + 1)


def unimportant(features: DataFrame, least: float) -> DataFrame:
    """(host, key) of what goes: the branches of low importance, and in all branches the single texts (content nodes) of
    low importance, whose key is the hash of branch and text. A text on n of a branch's m pages has the importance
    1 - log n / log (m + 1)."""
    # a text on n pages that is not low on n pages is low on no number; it only adds to its branch
    n = F.when(F.col("kind") == 0, F.col("pages"))
    often = F.when(smoothed(F.lit(0.0), n) < least, F.col("feature")).alias("often")
    parts = checkpointed(branch_sums(features, "host", "branch", often))
    sums = parts.groupBy("host", "branch").agg(F.max("m").alias("m"), *[F.sum(c).alias(c) for c in ("text_log", "texts", "shape_log", "shapes", "kinds")])
    found = judged(sums)
    branches = found.where(smoothed(F.col("importance"), F.col("pages")) < least).select("host", F.col("branch").alias("key"))
    nodes = parts.where("often IS NOT NULL").select("host", "branch", "often", F.col("texts").alias("n")).join(found, ["host", "branch"])
    nodes = nodes.where(1 - F.log("n") / F.log(F.col("pages").cast("double") + 1) < least)
    return branches.unionByName(nodes.select("host", F.xxhash64("branch", "often").alias("key")))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """page_id, url, text, n_chars for every row.

    Elements that name themselves boilerplate go, with all below them, but a class or id drops no element around the
    page's article, or without an article around most of its text, nor all text of a page. If the page has an article or main element, only
    its blocks count. Of what is left, the host's style tree removes

    * branches of low importance, but for plain article text: neither it nor an element between it and the article has a
      class, id or role;
    * single texts of low importance in their innermost branch, plain article text too: a notice in the article that most pages of
      the host have. Parts of headings, lists, tables, quotations and preformatted text are not judged singly, and a page
      of which more than half the characters would go keeps all of them, so pages with the same article keep it.

    Importance is smoothed, so what all pages of a host share goes from four different pages on. A page that would lose
    all its text to the tree keeps it. Pages of a host with the same texts count once (in the markup whose hash is
    the least), so copies of a page do not make its text look like boilerplate.

    Null or empty html gives an empty text; a null url is a host of its own name, the empty one; null ids and repeated
    rows stay; an empty table gives no rows; other columns are not read.
    """
    table = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    table = table.withColumn("host", host_of(F.col("url")))

    def parse(parts):
        for part in parts:
            for start in range(0, len(part), 256):
                some = part.iloc[start:start + 256]
                found = [_read(h) for h in some["html"]]
                yield some[["page_id", "url", "host"]].assign(**{k: [f[k] for f in found] for k in ("mark", "form", "texts", "free", "part", "branches", "shapes")})

    read = checkpointed(table.mapInPandas(
        parse, "page_id {}, url string, host string, mark long, form long, texts array<string>, free array<boolean>, part array<boolean>, branches array<array<long>>, "
        "shapes array<struct<branch: long, shape: long>>".format(table.schema["page_id"].dataType.simpleString())))
    # one row per different page of a host, counted before anything is multiplied out
    page = F.struct(F.transform("texts", lambda t: F.xxhash64(t)).alias("marks"), "branches", "shapes")
    once = read.groupBy("host", "mark").agg(F.min_by(page, "form").alias("page")).select("host", "page.*")

    def feature(branch, kind, value):
        return F.struct(branch.alias("branch"), F.lit(kind).alias("kind"), value.alias("feature"))

    texts = F.flatten(F.transform(F.arrays_zip("marks", "branches"), lambda b: F.transform(b["branches"], lambda x: feature(x, 0, b["marks"]))))
    shapes = F.flatten(F.transform("shapes", lambda s: F.array(feature(s["branch"], 1, s["shape"]), feature(s["branch"], 2, F.lit(0).cast("long")))))
    features = once.select("host", F.inline(F.concat(F.array_distinct(texts), shapes))).groupBy("host", "branch", "kind", "feature").agg(F.count(F.lit(1)).alias("pages"))
    low = checkpointed(unimportant(features, min_importance))
    few = low.count() <= BROADCAST_BRANCHES
    low = low.groupBy("host").agg(F.collect_set("key").alias("low"))
    joined = read.join(F.broadcast(low) if few else low, "host", "left")
    blocks = F.arrays_zip("texts", "free", "part", "branches")

    def size(some):
        return F.aggregate(some, F.lit(0).cast("long"), lambda n, b: n + F.length(b["texts"]))

    def single(b):
        return F.array_contains(F.col("low"), F.xxhash64(F.try_element_at(b["branches"], F.lit(-1)), F.xxhash64(b["texts"])))

    out = joined.withColumn("left", F.when(F.col("low").isNotNull(), F.filter(blocks, lambda b: b["free"] | ~F.arrays_overlap(b["branches"], F.col("low")))))
    out = out.withColumn("kept", F.filter("left", lambda b: b["part"] | ~single(b)))
    kept = F.when(2 * size(F.col("kept")) >= size(F.col("left")), F.col("kept")).otherwise(F.col("left"))
    chosen = F.when(F.size("left") > 0, F.transform(kept, lambda b: b["texts"])).otherwise(F.col("texts"))
    return out.select("page_id", "url", F.array_join(chosen, "\n\n").alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def _read(source: str | None) -> dict:
    page = Page(source or "")
    blocks = [b for b in page.blocks if b[1]] or page.blocks
    branches = dict.fromkeys(branch for b in blocks for branch in b[3])
    texts = [b[0] for b in blocks]
    form = _hash(" ".join(str(x) for b in blocks for x in b[3]))
    return {"mark": _hash("\n".join(texts)), "form": form, "texts": texts, "free": [b[1] and b[2] for b in blocks], "part": [b[4] for b in blocks], "branches": [b[3] for b in blocks],
            "shapes": [{"branch": b, "shape": _hash(" ".join(page.shapes.get(b, ())))} for b in branches]}


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)
