"""Main text of web pages by two-pass block rules.

A page is read once into blocks: runs of text between block-level tags, with their words, linked
characters, stop words and sentence marks, and the container they stand in.  Pass 1 decides each block from link
density, length, stop-word density and container.  Menus, headers, footers, sidebars, notices, adverts, forms and
reader comments are never main text: they are known by their tags and roles, or by the class or id of a container.
A class of a paragraph or heading itself decides only if the block is short or full of links, never alone
against prose.  Stop words know four languages; a long block with sentence marks in any script is prose as
well, and length counts two characters of scripts without blanks as a word.  Pass 2 gives each undecided block the
label of the nearest decided block of its container; where a page has none, blocks in an ``article`` or ``main``
element stay, and on pages without such an element those that end like a sentence.

Defined results: a null or blank page has an empty text; unclosed elements end with the page or where a
block-level tag ends them; character references are decoded, white space inside a block becomes one space;
an empty table gives an empty table; columns of the caller are kept, ``text_col`` is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MAX_LINK_DENSITY = 0.33
LONG_WORDS = 10
GOOD_STOP_DENSITY = 0.15
MARK_EVERY = 40          # words: prose has a sentence mark in so many
LETTER_SHARE = 0.6       # of the characters of prose

#: Frequent function words of four languages.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their "
    "they this to was we were which will with you "
    "der die das den dem des ein eine einen und oder ist sind war nicht mit von zu auf für im in als auch an es sich "
    "le la les un une des du de et ou est sont pas que qui dans pour par sur au aux avec ce se il elle en "
    "el los las una unos del y o es son no con para por como se su al lo".split())

SKIPPED = frozenset("head script style noscript template svg math iframe object select textarea title option canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER_TAGS = frozenset("nav header footer aside form dialog menu button fieldset address".split())
MAIN_TAGS = frozenset("article main".split())
ENDED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 dt dd li".split())
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent copyright disclaimer disqus footer header login masthead menu nav navbar navigation newsletter notice "
    "notices pagination popup promo promoted related reply replies respond share sharing sidebar signup skip social "
    "sponsor sponsored subscribe toolbar widget".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words that name the part of a layout that another word of the same class speaks of.
LAYOUT_WORDS = frozenset(
    "area bar block body bottom box col column container content footer group header holder inner item items left line links list "
    "main module nav outer overlay panel right row section slot text title top unit wrap wrapper".split())
#: A class of these elements speaks of one block, not of a container.
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre td th dd dt figcaption".split())
#: Marks of sentences in the scripts that use them; the first group ends a sentence.
SENTENCE_ENDS = ".!?…。！？｡।؟።៕։"
SENTENCE_MARKS = frozenset(SENTENCE_ENDS + ",;:，、；：،؛")
_SPACELESS = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def names_boilerplate(value: str) -> bool:
    """Whether a class or id names something around the main text: one of its names is such a word, alone or with layout words."""
    for name in value.lower().split():
        parts = [w for w in re.split(r"[^a-z]+", name) if w]
        said = [w for w in parts if w in BOILER_WORDS]
        if said and (parts[-1] in BOILER_WORDS or all(w in BOILER_WORDS or w in LAYOUT_WORDS for w in parts)):
            return True
    return False


@dataclass
class Block:
    container: int          # the nearest article or main element, or 0 for the page
    in_main: bool
    boiler: bool
    hinted: bool = False    # by the class of the paragraph or heading itself
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def close(self) -> bool:
        self.words = "".join(self.parts).split()
        self.text = " ".join(self.words)
        return bool(self.words)

    def length(self) -> int:
        """In words; two characters of a script without blanks count as one."""
        spaceless = len(_SPACELESS.findall(self.text))
        return len(self.words) + spaceless // 2 if spaceless else len(self.words)

    def is_sentence(self) -> bool:
        return self.text.rstrip("\"')]»”’」』")[-1:] in SENTENCE_ENDS and self.text[-1:] != ""

    def decided(self) -> bool | None:
        """Pass 1: main text, not, or open."""
        if self.boiler or self.linked > MAX_LINK_DENSITY * len(self.text):
            return False
        long = self.length() >= LONG_WORDS
        if long:
            stops = sum(w.lower().strip(".,;:!?\"'()") in STOP_WORDS for w in self.words)
            if stops >= GOOD_STOP_DENSITY * len(self.words):
                return True
            marks = sum(c in SENTENCE_MARKS for c in self.text)
            letters = sum(c.isalpha() for c in self.text)
            if marks * MARK_EVERY >= self.length() and letters >= LETTER_SHARE * len(self.text) and self.is_sentence():
                return True
        return False if self.hinted and not long else None


class PageReader(HTMLParser):
    """Blocks of a page, in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, bool, int, bool]] = []  # (tag, boiler, container, hinted) of each open element
        self.skip = self.links = self.breaks = self.containers = 0
        self.block: Block | None = None

    def _end_block(self) -> None:
        if self.block is not None and self.block.close():
            self.blocks.append(self.block)
        self.block, self.breaks = None, 0

    def _pop_to(self, depth: int) -> None:
        for tag, *_ in self.open[depth:]:
            self.skip -= tag in SKIPPED
            self.links -= tag == "a"
        del self.open[depth:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.breaks += 1
            if self.breaks > 1:
                self._end_block()
            elif self.block is not None:
                self.block.parts.append(" ")
            return
        if tag not in INLINE:
            self._end_block()
            if tag == "body":  # whatever was left open before is not around the page
                self._pop_to(0)
            for d in range(len(self.open) - 1, -1, -1):
                if self.open[d][0] in ENDED_BY_BLOCK and (tag not in ("ul", "ol", "dl") or self.open[d][0] not in ("li", "dd")):
                    self._pop_to(d)
                    break
                if self.open[d][0] not in INLINE:
                    break
        if tag in VOID:
            return
        boiler, container, hinted = self.open[-1][1:] if self.open else (False, 0, False)
        if tag in MAIN_TAGS and not boiler:
            self.containers += 1
            container = self.containers
        if tag in BOILER_TAGS and not (tag == "header" and container):
            boiler = True
        for name, value in attrs:
            if not value or tag in ("html", "body") or tag in MAIN_TAGS:
                continue
            if name in ("class", "id") and names_boilerplate(value):
                own = container and {w for w in re.split(r"[^a-z]+", value.lower()) if w in BOILER_WORDS} <= {"header"}
                if tag in TEXT_TAGS:
                    hinted = True
                elif not own:  # the header of an article is its title
                    boiler = True
            elif name == "role":
                boiler = boiler or value.lower() in BOILER_ROLES
        self.open.append((tag, boiler, container, hinted))
        self.skip += tag in SKIPPED
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self._end_block()
        for d in range(len(self.open) - 1, -1, -1):
            if self.open[d][0] == tag:
                self._pop_to(d)
                return
            if tag in INLINE and self.open[d][0] not in INLINE:
                return

    def handle_data(self, data: str) -> None:
        if self.skip:
            return
        if self.block is None:
            if data.isspace():
                return
            _, boiler, container, hinted = self.open[-1] if self.open else ("", False, 0, False)
            self.block = Block(container, container > 0, boiler, hinted)
        self.block.parts.append(data)
        if not data.isspace():
            self.breaks = 0
            if self.links:
                self.block.linked += len(" ".join(data.split()))

    def finished(self) -> list[Block]:
        self.close()
        self._end_block()
        return self.blocks


def _labels(blocks: list[Block]) -> list[bool]:
    """Pass 2: open blocks take the label of the nearest decided block of their container."""
    first = [b.decided() for b in blocks]
    has_main = any(b.in_main for b in blocks)
    before: list[tuple[int, bool] | None] = []
    after: list[tuple[int, bool] | None] = [None] * len(blocks)
    last: dict[int, tuple[int, bool]] = {}
    for i, b in enumerate(blocks):
        if first[i] is not None and not b.boiler:
            last[b.container] = (i, first[i])
        before.append(last.get(b.container))
    last = {}
    for i in range(len(blocks) - 1, -1, -1):
        if first[i] is not None and not blocks[i].boiler:
            last[blocks[i].container] = (i, first[i])
        after[i] = last.get(blocks[i].container)
    out = []
    for i, b in enumerate(blocks):
        if first[i] is not None:
            out.append(first[i])
        elif not before[i] and not after[i]:
            out.append(b.in_main or not has_main and b.is_sentence())
        elif before[i] and after[i]:
            left, right = i - before[i][0], after[i][0] - i
            out.append(before[i][1] or after[i][1] if left == right else (before[i] if left < right else after[i])[1])
        else:
            out.append((before[i] or after[i])[1])
    return out


def main_text(html: str) -> str:
    reader = PageReader()
    reader.feed(html)
    blocks = reader.finished()
    return "\n".join(b.text for b, keep in zip(blocks, _labels(blocks), strict=True) if keep)


def extract_text(pages: DataFrame, html_col: str = "html", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``pages`` (all by default) with the main text of each page in ``text_col``."""
    keep = [c for c in (pages.columns if keep is None else keep) if c != text_col]
    schema = T.StructType([*[pages.schema[c] for c in keep], T.StructField(text_col, T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py() or "") for h in batch.column("__html")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).cast(arrow.field(c).type) for c in keep], pa.array(texts, arrow.field(text_col).type)],
                schema=arrow)
    html = F.col(f"`{html_col}`").cast("string").alias("__html")
    return pages.select(*[F.col(f"`{c}`") for c in keep], html).mapInArrow(run, schema)
