"""The main text of web pages by two-pass block rules.

Markup cuts a page into blocks. The first pass decides those that tell by themselves: a
block is boilerplate inside an element that is (menus, headers, footers, sidebars, forms,
or one whose class, id or role says so), or if mostly links; it is text if long and rich in
stop words. A name that only says so in part (``search-box``) holds where no block in the
element is text by itself; no name holds against an article element, unless there is one
elsewhere with text, nor where nothing would be left as text. Names of reader comments hold
whatever the prose, on any element beside or within the article, unless no other block is
left. A paragraph or heading of an article may be one link. A menu or the like that is never
closed counts as named in part. All other blocks are short or ambiguous; in the second pass
they take the label of the nearest decided neighbours, the stop-word richer one's if these differ and
are equally near. Where the page marks its article, the edges of that element count as
decided neighbours: text on the inside, boilerplate on the outside. Where nothing is
decided, what is left is text. Stop words are those of a few languages: where no article is
marked and most of the long unlinked text has too few of them, length and links alone decide.

Comments, scripts, styles, heads and unfinished tags at a page's end are no text, nor is what
closed noscript, template, svg, iframe and object elements hold; of these, one that is not
closed within its parent drops nothing. A head ends at the first tag or text that cannot be in one. Character
references are decoded, white space within a block becomes one space, blocks are joined
in page order by an empty line.

Defined cases: a null or empty page has an empty text; a page without markup is one block;
repeated pages are judged alike; pages are read whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Frequent words of the corpus languages.
STOP_WORDS = frozenset(
    """a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their
    there they this to was we were which will with you
    als am auch auf aus bei das dem den der des die ein eine einen einer es für hat ich im in ist mit nach nicht oder
    sich sie sind so und vom von war werden wie wird zu zum zur
    au aux avec ce ces cette dans de des du elle en est et être il ils je la le les leur mais ne nous on ou par pas
    plus pour qu que qui sa se ses son sont sur un une vous y
    al como con del el ella en entre era es esta este fue ha hay las lo los más muy no nos o para pero por que se sin
    sobre su sus también un una uno ya""".split()
)
#: Elements that never hold the main text, and words of a class, id or role that say so.
BOILERPLATE = frozenset("nav footer aside form button select textarea menu dialog".split())
HINTS = frozenset(
    """ad ads advert adverts advertisement sponsored promo promotion sidebar nav navbar navigation menu menubar breadcrumb
    breadcrumbs pagination footer masthead cookie cookies consent gdpr notice banner popup modal newsletter subscribe
    signup login share sharing social related recommended comment comments disqus contentinfo complementary search""".split()
)
#: Parts of names that tell of reader comments.
COMMENTS = frozenset("comment comments commentlist commentarea disqus".split())
#: What is not text, in full, and runs to the end of the page where it is left open.
_DROPPED = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)", re.I | re.S)
#: Elements whose content is not text, if they are closed.
_UNSEEN = frozenset("noscript template svg iframe object".split())
_ANY_UNSEEN = re.compile(r"<(?:head|noscript|template|svg|iframe|object)\b", re.I)
#: What a head can hold; anything else ends it.
_IN_HEAD = frozenset("head base basefont bgsound link meta title noscript template noframes".split())
_TITLE_END = re.compile(r"</title\s*>|</?(?:head|body)\b", re.I)
_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>|<[!?/a-zA-Z][^<>]*(?:>|\Z)""")

_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: A name that begins or ends so tells of the page, not of the element.
_STATES = frozenset("has no not with without".split())
_PAGES = frozenset("page layout open closed enabled disabled".split())
_HREF = re.compile(r"""(?:^|[\s"'/])href(?=[\s=/]|$)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile(r"[^\W\d_]+")
#: Inline elements don't end a block.
_INLINE = frozenset(
    """a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small
    span strike strong sub sup time tt u var wbr""".split()
)
_VOID = frozenset("area base col embed hr input link meta param source track".split())
_ARTICLE = frozenset(("article", "main"))
#: Elements that hold a paragraph, which may be a link in full.
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote figcaption dd dt".split())
#: Characters and shares that decide.
SHORT, LONG, LINKS, STOPS = 70, 200, 0.5, 0.3


@dataclass
class Block:
    text: str
    linked: int
    boilerplate: bool
    article: int
    """Number of the article element that it is in, 0 outside."""
    named: int = 0
    """Number of the innermost element around it whose name says boilerplate in part, 0 without."""
    said: int = 0
    """The same of those whose name says it in full."""
    outside: tuple[int, int] = (0, 0)
    """``named`` and ``said`` around its article element."""
    comment: bool = False
    """Whether an element around it, within its article, is named for comments."""
    element: str = ""

    def weight(self) -> int:
        """The length; a sign of a script without spaces counts as three letters."""
        return len(self.text) + 2 * sum(c >= "\u2e80" for c in self.text)

    def label(self) -> bool | None:
        if self.boilerplate or self.linked > LINKS * len(self.text) and not (self.article and self.element in _PROSE):
            return False
        if len(self.text) < SHORT:
            return None
        words = _WORD.findall(self.text.lower())
        stops = sum(w in STOP_WORDS for w in words) / max(len(words), 1)
        return True if stops >= STOPS and len(self.text) >= LONG or stops >= 1.2 * STOPS else None


def _hint(name: str, attributes: str) -> int:
    """Whether the element's names say boilerplate: 3 comments, 2 in full, 1 in part, 0 not."""
    if name in ("body", "html") or not attributes:
        return 0
    found = 0
    for match in _MARKS.finditer(attributes):
        for word in (match[1] or match[2] or match[3] or "").lower().split():
            parts = [part for part in re.split(r"[^a-z]+", word) if part]
            hints = sum(part in HINTS or part in COMMENTS for part in parts)
            if hints and parts[0] not in _STATES and parts[-1] not in _PAGES:
                found = max(found, 3 if COMMENTS & set(parts) else 2 if hints == len(parts) else 1)
    return found


def _hidden(name: str, attributes: str) -> bool:
    return bool(attributes) and name not in _ARTICLE and name not in ("body", "html") and bool(_HIDDEN.search(attributes))


def _confirm(blocks: list[Block], parents: list[int]) -> None:
    """Make those blocks boilerplate whose elements' names say so, where the blocks agree.

    ``parents`` has, for each partly named element, the next one around it.
    """
    if any(not block.comment and not block.boilerplate and block.weight() >= SHORT for block in blocks):
        for block in blocks:
            block.boilerplate = block.boilerplate or block.comment
    rich = [block.label() is True for block in blocks]
    # An article in named elements stands by itself if no other one has text.
    if not any(text and block.article and block.outside == (0, 0) for block, text in zip(blocks, rich)):
        for block in blocks:
            if block.article:
                if block.named == block.outside[0]:
                    block.named = 0
                block.outside = (0, 0)
    unconfirmed = {0}
    for block, text in zip(blocks, rich):
        at = block.named
        while text and at not in unconfirmed:
            unconfirmed.add(at)
            at = parents[at]
    marked = any(block.article and not block.outside[1] and not block.boilerplate for block in blocks)

    def says(block: Block) -> bool:
        return bool(block.said or block.outside[1]) or block.named not in unconfirmed

    def left(block: Block, text: bool) -> bool:
        return not block.boilerplate and not says(block) and (bool(block.article) if marked else text)

    free = set()
    if not any(map(left, blocks, rich)):
        free = {block.said for block, text in zip(blocks, rich) if text and (block.article or not marked) and not block.outside[1]}
    for block in blocks:
        if says(block) and (block.outside[1] or block.said not in free or block.named not in unconfirmed):
            block.boilerplate = True


def _closed(tags: list[re.Match]) -> dict[int, int]:
    """Start of each unseen element that is closed within its parent, and its end."""
    found: dict[int, int] = {}
    open_: list[tuple[str, int]] = []
    count: dict[str, int] = {}
    for tag in tags:
        name = (tag[2] or "").lower()
        if not name or name in _INLINE or name in _VOID or name == "p" or name == "svg" and tag[3].endswith("/"):
            continue
        if not tag[1]:
            open_.append((name, tag.start()))
            count[name] = count.get(name, 0) + 1
        elif count.get(name):
            while True:
                last, start = open_.pop()
                count[last] -= 1
                if last == name:
                    break
            if name in _UNSEEN:
                found[start] = tag.end()
    return found


def _left_open(tags: list[re.Match]) -> set[int]:
    """Starts of boilerplate elements that nothing closes but the end of an outer element or of the page."""
    found: set[int] = set()
    open_: list[tuple[str, int]] = []
    count: dict[str, int] = {}
    for tag in tags:
        name = (tag[2] or "").lower()
        if not name or name in _INLINE or name in _VOID or name == "p":
            continue
        if not tag[1]:
            open_.append((name, tag.start()))
            count[name] = count.get(name, 0) + 1
        elif count.get(name):
            while True:
                last, start = open_.pop()
                count[last] -= 1
                if last == name:
                    break
                if last in BOILERPLATE:
                    found.add(start)
    return found | {start for name, start in open_ if name in BOILERPLATE}


def _head_end(page: str, tags: list[re.Match], k: int, closed: dict[int, int]) -> int:
    """Where the head that opens with tag ``k`` ends."""
    at, title, ends = tags[k].end(), False, True
    for n in range(k + 1, len(tags)):
        tag = tags[n]
        if tag.start() < at:
            continue
        name = (tag[2] or "").lower()
        if not title and page[at : tag.start()].strip():
            return at
        if name == "head" and tag[1]:
            return tag.end()
        if name and (name in ("body", "html") if tag[1] else name not in _IN_HEAD):
            return tag.start()
        at = closed.get(tag.start(), tag.end())
        title = name == "title" and not tag[1]
        if title and ends:
            end = _TITLE_END.search(page, at)
            ends = end is not None
            if end and end[0].lower().startswith("</title"):
                at, title = end.end(), False
    return len(page) if title or not page[at:].strip() else at


def _seen(page: str) -> str:
    """The page without what is not text."""
    page = _DROPPED.sub(" ", page)
    if not _ANY_UNSEEN.search(page):
        return page
    tags = list(_TAG.finditer(page))
    closed = _closed(tags)
    parts, at = [], 0
    for k, tag in enumerate(tags):
        if tag.start() < at:
            continue
        end = closed.get(tag.start())
        if not tag[1] and (tag[2] or "").lower() == "head":
            end = _head_end(page, tags, k, closed)
        if end is not None:
            parts += [page[at : tag.start()], " "]
            at = end
    return "".join([*parts, page[at:]])


def blocks_of(page: str) -> list[Block]:
    page = _seen(page)
    tags = list(_TAG.finditer(page))
    # Links that are closed before the next one begins.
    whole, end = set(), False
    for tag in reversed(tags):
        if tag[2] in ("a", "A"):
            if end and not tag[1]:
                whole.add(tag.start())
            end = bool(tag[1])
    left_open = _left_open(tags)
    out: list[Block] = []
    # Name, boilerplate, article, innermost element named in part, in full, both around the article, comment.
    outer = ("", False, 0, 0, 0, (0, 0), False)
    open_: list[tuple[str, bool, int, int, int, tuple[int, int], bool]] = []
    parents = [0]
    parts: list[str] = []
    linked = articles = names = at = 0
    #: Of text: not, to the end of the block, or to the end of the link.
    links = 0

    def end_block() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            element, *around = open_[-1] if open_ else outer
            out.append(Block(text, min(linked, len(text)), *around, element))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if links:
                linked += len(" ".join(html.unescape(text).split()))

    for tag in tags:
        add(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name in _INLINE:
            if name == "a":
                links = 0 if tag[1] or not _HREF.search(tag[3]) else 2 if tag.start() in whole else 1
            elif name == "br":
                parts.append(" ")
            continue
        end_block()
        # A link that is left open ends with its block.
        links = 0 if links == 1 else links
        if name in _VOID:
            continue
        if name == "p":
            # Paragraphs are left open freely; only what they are marked as counts.
            if not tag[1] and open_ and open_[-1][0] == "p":
                open_.pop()
            if tag[1]:
                if open_ and open_[-1][0] == "p":
                    open_.pop()
                continue
        if tag[1]:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    del open_[k:]
                    links = 0
                    break
            continue
        _, bad, article, named, said, outside, comment = open_[-1] if open_ else outer
        hint = _hint(name, tag[3])
        endless = tag.start() in left_open
        if endless and not hint:
            hint = 1
        if hint == 3:
            comment = comment or name not in _ARTICLE
        if name in _ARTICLE:
            # A page's article may stand in what is named for its comments.
            comment = comment and (bool(article) or hint == 3)
            # Names of article elements count only where one around them says the same.
            if not article:
                articles += 1
                article = articles
                if not (hint and (said or named)):
                    outside, said = (named, said), 0
        elif hint == 2:
            names += 1
            said = names
        elif hint == 1:
            parents.append(named)
            named = len(parents) - 1
        bad = bad or name in BOILERPLATE and not endless or name == "header" and not article or _hidden(name, tag[3])
        open_.append((name, bad, article, named, said, outside, comment))
    add(page[at:])
    end_block()
    _confirm(out, parents)
    return out


def _by_length(blocks: list[Block], first: list[bool | None]) -> list[bool | None]:
    """Labels of a page in a language whose stop words aren't known: long undecided blocks are text."""
    known = sum(block.weight() for block, label in zip(blocks, first) if label)
    for least in (LONG, SHORT) if not known else (LONG,):
        long = [label is None and block.weight() >= least for block, label in zip(blocks, first)]
        if sum(block.weight() for block, chosen in zip(blocks, long) if chosen) > known:
            return [True if chosen else label for chosen, label in zip(long, first)]
    return first


def labelled(blocks: list[Block]) -> list[bool]:
    """Whether each block is text."""
    first = [block.label() for block in blocks]
    marked = any(block.article for block in blocks)
    if not marked:
        first = _by_length(blocks, first)

    def sweep(order) -> list[tuple[int, bool]]:
        """For each block the distance to the nearest decided one behind, and its label."""
        found, distance, label, before = {}, 1 << 30, True, None
        for k in order:
            block = blocks[k]
            if marked and (before is None or before.article != block.article):
                distance, label = 0, bool(block.article)
            distance += 1
            found[k] = (distance, label)
            # Boilerplate inside a text says nothing about its neighbours.
            if first[k] is not None and not (first[k] is False and block.article):
                distance, label = 0, first[k]
            before = block
        return [found[k] for k in range(len(blocks))]

    ahead, behind = sweep(range(len(blocks))), sweep(range(len(blocks) - 1, -1, -1))
    out = []
    for label, (da, la), (db, lb) in zip(first, ahead, behind):
        if label is None:
            label = la if da < db else lb if db < da else la or lb
        out.append(label)
    return out


def main_text(page: str) -> str:
    blocks = blocks_of(page)
    return "\n\n".join(block.text for block, text in zip(blocks, labelled(blocks)) if text)


def extracted(page: Column) -> Column:
    """The main text of a page."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(page.as_py() or "") for page in batch], type=pa.string())

    return text(page)
