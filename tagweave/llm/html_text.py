"""Main text of web pages: the host's suffix arrays judge every page, mark-up says how much it takes.

Repetition alone gives wrong texts: adverts and menus can differ on every page,
and articles, or passages of them, do repeat across pages. So each block of a
page is put down by its mark-up as chrome (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, reader comments), as article (inside
``article`` or, in a page without one, ``main``), or as open: everything else.
Chrome goes, as if it were not there. Class names and ids are only
hints: an article or main inside such a part is taken if the page has no other,
one inside reader comments only if there is no text else.

The other blocks of a host's pages are two token streams for each page, marked and
open, and suffix arrays (``suffix``) find the strings of ``REPEATED`` bytes and more
that distinct texts of the host share. How many must share them goes by the mark-up:

* Marked text, of hosts with ``HOST_TEXTS`` different ones at least: more than half of
  them. Blocks that such strings cover wholly are the host's (a call to subscribe in
  every article) and go, unless they are more than half of the page's marked text.
  The host's different texts are dealt by hash to groups of ``GROUP`` or so. An anchor
  that at most a quarter of a group has can hold no string that more have, so only
  frequent anchors are cut out of the texts; the suffix arrays of a group find the
  strings that more than a quarter of it has, and count the texts. The counts of the
  groups are summed. A host with one group is exact; with more, a group in which at
  most a quarter of the texts have a string counts as none for it.
* Open text: two. The strings are removed wherever they cover whole tokens; the runs
  between them stay. That is done where a page has more open text than marked text,
  as the article may be a teaser then: what is left of the open text is the main text
  if it is still longer. All pages' open text shows what repeats. Strings of pages of one host meet under the smallest hash of
  their substrings, and equal units are one before they are sorted, so a host with a
  third of all pages is no single task.

Defined cases: a null or empty page has the text ``""``, and so has one without
any text. A null URL is a host of its own name, empty. Repeated rows are pages of
their own with the same text; an id says nothing about that, and a run counts as
shared only if two pages that differ in their texts share it. Texts are read whole,
however long. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tagweave.llm.common import text_or_empty
from tagweave.llm.repeats import _bytes_of, free_shuffles, units
from tagweave.llm.suffix import _ranges, suffix_arrays
from tagweave.llm.urls import url_host
from tagweave.storage import stage

#: Bytes of a string that makes boilerplate when pages of a host share it.
REPEATED = 48
SORTED, MOST_UNITS = 1 << 20, 64
#: For marked text: different texts that a host must have to be judged, texts of a group, bytes of their
#: anchors' least substrings, bytes of anchors counted at a time.
HOST_TEXTS, GROUP, MARKED_SEED, LISTED = 16, 512, 16, 1 << 25

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead title tr ul".split()
)
_CHROME = frozenset(
    "aside button canvas datalist dialog fieldset footer form head iframe input label legend menu nav noscript object option "
    "script search select style svg template textarea title".split()
)
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Class names and ids that mark chrome, alone or with words of ``_AROUND`` before or after.
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment commentlist comments consent cookie "
    "cookies disqus discussion footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification "
    "overlay popup promo promoted promotion related replies reply share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar widget".split()
)
#: The same on an article that stands beside the main one.
_TEASERS = frozenset("ad ads advert adverts advertisement advertising promo promoted promotion related sponsor sponsored".split())
_COMMENTS = frozenset("comment commentlist comments disqus discussion replies reply".split())
_AROUND = frozenset(
    "area bar block body bottom box button buttons card container footer form global header inner item items left link links "
    "list main message page panel post posts primary right secondary section site slot text top unit wrap wrapper".split()
)
#: What is not captured: chrome for good, and what only a hint says, in which an article or main still counts.
_HIDDEN = ("chrome", "hinted", "comments")
_SECTIONS = frozenset("article aside footer form header main nav section".split())
#: Elements whose end ends nothing outside the section they are in; a block's start ends an open paragraph.
_NAME = re.compile(r"[A-Za-z]+")


def _hints(given: dict[str, str | None]) -> set[str]:
    """Hint words of class names and ids whose other words do not turn their sense."""
    found: set[str] = set()
    for token in f"{given.get('class') or ''} {given.get('id') or ''}".split():
        words = {w.lower() for w in _NAME.findall(token)}
        if words <= _HINTS | _AROUND:
            found |= words & _HINTS
    return found


class _Page(HTMLParser):
    """Blocks of a page with what they are: ``article``, ``main``, ``within`` (an article or main in a
    part that a hint marks), ``thread`` (the same in reader comments) or ``open``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str]] = []
        self.blocks: list[tuple[str, str]] = []
        self.held: list[str] = []
        self.held_zone = "open"

    def zone(self) -> str:
        return self.stack[-1][1] if self.stack else "open"

    def flush(self) -> None:
        text = " ".join("".join(self.held).split())
        self.held = []
        if text:
            self.blocks.append((self.held_zone, text))

    def kind(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        now = self.zone()
        if now == "chrome" or tag in _CHROME or (tag == "header" and now == "open"):
            return "chrome"
        given = dict(attrs)
        if (given.get("role") or "").lower() in _ROLES or "hidden" in given:
            return "chrome"
        if tag not in ("html", "body", "main"):
            found = _hints(given) & (_COMMENTS | _TEASERS if tag == "article" else _HINTS)
            if tag == "article" and found and not found & _COMMENTS:
                return "thread" if now in ("comments", "thread") else "within"
            if found:
                return "comments" if now in ("comments", "thread") or found & _COMMENTS else "hinted"
        if tag in ("article", "main"):
            if now in ("comments", "thread"):
                return "thread"
            if now in ("hinted", "within"):
                return "within"
            return tag
        return now

    def hides(self) -> bool:
        return self.zone() in _HIDDEN

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            if tag == "hr" and not self.hides():
                self.flush()
            elif tag in ("br", "wbr", "img"):
                self.space()
            return
        # What is hidden is left out as if it were not there: blocks inside it end no paragraph around it.
        if tag in _BLOCK:
            self.close_paragraph(tag)
            if not self.hides():
                self.flush()
        self.stack.append((tag, self.kind(tag, attrs)))

    def close_paragraph(self, tag: str) -> None:
        """A block's start ends an open paragraph, but not through an element that hides what is in it.

        Of those only an inline one that a mere hint marks gives way, and to another paragraph only:
        its own end is missing then.
        """
        for at in range(len(self.stack) - 1, -1, -1):
            name, zone = self.stack[at]
            if name == "p":
                del self.stack[at:]
                return
            outside = self.stack[at - 1][1] if at else "open"
            if name in _SECTIONS:
                return
            if zone in _HIDDEN and outside not in _HIDDEN and (zone == "chrome" or name in _BLOCK or tag != "p"):
                return

    def space(self) -> None:
        if not self.hides():
            self.held.append(" ")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag not in ("p", "div", "script", "style"):
            self.handle_endtag(tag)

    def end(self, tag: str) -> None:
        for at in range(len(self.stack) - 1, -1, -1):
            name = self.stack[at][0]
            if name == tag:
                del self.stack[at:]
                return
            if name in _SECTIONS and tag not in _SECTIONS and tag not in ("body", "html"):
                return

    def handle_endtag(self, tag):
        if tag in _VOID:
            if tag == "br":
                self.space()
            return
        if tag in _BLOCK and not self.hides():
            self.flush()
        self.end(tag)

    def handle_data(self, data):
        zone = self.zone()
        if zone in _HIDDEN:
            return
        if zone != self.held_zone:
            self.flush()
            self.held_zone = zone
        self.held.append(data)


def parts(html: str) -> tuple[str, list[str], list[str]]:
    """What marks the main part (``article``, ``main``, ``open`` if nothing does), its blocks, and the open blocks."""
    page = _Page()
    page.feed(html)
    if page.rawdata.startswith("<!--"):  # a comment without an end goes on to the end of the page
        page.rawdata = ""
    page.close()
    page.flush()
    found: dict[str, list[str]] = {}
    for zone, text in page.blocks:
        found.setdefault(zone, []).append(text)
    opened = found.get("open", [])
    # A zone counts only if it has text: else the next one may be the main part.
    for zone in ("article", "main", "within"):
        if zone in found:
            return "main" if zone == "main" else "article", found[zone], opened
    if not opened and "thread" in found:
        return "article", found["thread"], []
    return "open", [], opened


def size(found: list[str]) -> int:
    return sum(map(len, found))


def blocks(html: str) -> tuple[str, list[str]]:
    """Blocks of the main part by mark-up alone, and what marks it.

    Articles with less text than the open blocks beside them are teasers.
    """
    zone, marked, opened = parts(html)
    return (zone, marked) if size(marked) >= size(opened) else ("open", opened)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, others = [], []
        for html in batch.column("html"):
            _, marked, opened = parts(html.as_py())
            texts.append("\n\n".join(marked))
            others.append("\n\n".join(opened) or None)
        columns = [batch.column(c) for c in ("id", "url", "host")] + [pa.array(texts, "string"), pa.array(others, "string")]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "url", "host", "marked", "text"])


def _short(anchor: np.ndarray) -> np.ndarray:
    """32 bits of anchors, enough to tell which are frequent: the strings themselves are compared later."""
    return (anchor & 0xFFFFFFFF).astype(np.uint32).view(np.int32)


def _list_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different anchors of each text, as one value of 4 bytes each."""
    for batch in batches:
        data, bounds = _bytes_of(batch.column("body"))
        anchor, text, _, _ = units(data, bounds, REPEATED, MARKED_SEED)
        anchor = _short(anchor)
        ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
        lists = [np.unique(anchor[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("mark"), pa.array(lists, "binary")], names=["host", "mark", "anchors"])


def _usual_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors that more than a quarter of a group's texts have, or of a part of them that fits in memory."""

    def found(host: str, lists: list[bytes]) -> pa.RecordBatch:
        anchor, count = np.unique(np.frombuffer(b"".join(lists), np.int32), return_counts=True)
        anchor = anchor[count * 4 > len(lists)]
        return pa.RecordBatch.from_arrays([pa.array([host] * len(anchor), "string"), pa.array(anchor)], names=["host", "anchor"])

    held, size, last, mark = [], 0, None, None
    for batch in batches:
        for host, salt, now, listed in zip(*[batch.column(c).to_pylist() for c in ("host", "salt", "mark", "anchors")], strict=True):
            if held and ((host, salt) != last or size > LISTED):
                yield found(last[0], held)
                held, size = [], 0
            if (host, salt) == last and now == mark:
                continue
            last, mark = (host, salt), now
            held.append(listed)
            size += len(listed)
    if held:
        yield found(last[0], held)


def _usual_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units under the anchors that are frequent on the host."""
    for batch in batches:
        data, bounds = _bytes_of(batch.column("body"))
        anchor, text, start, run = units(data, bounds, REPEATED, MARKED_SEED)
        anchor, keep = _short(anchor), np.zeros(len(anchor), bool)
        ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
        usual = batch.column("usual")
        for row, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            keep[a:b] = np.isin(anchor[a:b], usual[row].values.to_numpy())
        anchor, text, start, run = anchor[keep], text[keep], start[keep], run[keep]
        begin, body = bounds[text] + start, data.tobytes()
        pieces = [body[a:b] for a, b in zip(begin.tolist(), (begin + run + REPEATED - 1).tolist(), strict=True)]
        where = pa.array(text)
        columns = [batch.column(c).take(where) for c in ("host", "n", "salt", "mark")]
        columns += [pa.array(anchor), pa.array(start.astype(np.int64)), pa.array(pieces, "binary")]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "n", "salt", "mark", "anchor", "start", "piece"])


def _count_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units sorted by host, group and anchor: strings that more than a quarter of the group's texts have, and how many do."""

    def found(held: list[tuple]) -> pa.RecordBatch:
        kinds: dict[tuple, tuple[int, set]] = {}
        group, of = -1, None
        for host, salt, anchor, n, m, mark, piece in held:
            if (host, salt, anchor) != of:
                group, of = group + 1, (host, salt, anchor)
            kinds.setdefault((group, piece), ((host, anchor, n, m), set()))[1].add(mark)
        groups = np.array([g for g, _ in kinds], np.int64)
        rows, marks = [r for r, _ in kinds.values()], [sorted(m) for _, m in kinds.values()]
        pieces = [p for _, p in kinds]
        unit, place, of = _equal_strings(groups, np.array([len(p) - REPEATED + 1 for p in pieces]), pieces)
        # Each string with each text that has it, once.
        many = np.array([len(m) for m in marks])
        owner = np.repeat(of, many[unit])
        texts = np.concatenate([np.array(m, np.int64) for m in marks])
        texts = texts[_ranges((np.cumsum(many) - many)[unit], np.cumsum(many)[unit])]
        by = np.lexsort((texts, owner))
        owner, texts = owner[by], texts[by]
        count = np.bincount(owner[np.concatenate(([True], (owner[1:] != owner[:-1]) | (texts[1:] != texts[:-1])))])
        out = []
        for first in np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))).tolist():
            host, anchor, n, m = rows[unit[first]]
            have = int(count[of[first]])
            if have * 4 > m and (m < n or have * 2 > n):
                out.append((host, anchor, pieces[unit[first]][place[first] : place[first] + REPEATED], n, have))
        kinds_of = (("host", "string"), ("anchor", "int32"), ("string", "binary"), ("n", "int64"), ("have", "int64"))
        columns = zip(*out, strict=True) if out else [[] for _ in kinds_of]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, k) in zip(columns, kinds_of, strict=True)], names=[c for c, _ in kinds_of])

    held, size = [], 0
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("host", "salt", "anchor", "n", "m", "mark", "piece")], strict=True):
            if size > SORTED and row[:3] != held[-1][:3]:
                yield found(held)
                held, size = [], 0
            held.append(row)
            size += len(row[6])
    if held:
        yield found(held)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where units have strings of the host: byte ranges of the text."""
    for batch in batches:
        out = []
        for host, mark, start, piece, strings in zip(*[batch.column(c).to_pylist() for c in ("host", "mark", "start", "piece", "strings")], strict=True):
            wanted = set(strings)
            at = [p for p in range(len(piece) - REPEATED + 1) if piece[p : p + REPEATED] in wanted]
            for k, p in enumerate(at):
                if not k or at[k - 1] != p - 1:
                    out.append([host, mark, start + p, 0])
                out[-1][3] = start + p + REPEATED
        kinds = (("host", "string"), ("mark", "int64"), ("first", "int64"), ("upto", "int64"))
        columns = zip(*out, strict=True) if out else [[] for _ in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, k) in zip(columns, kinds, strict=True)], names=[c for c, _ in kinds])


def judged(marked: str, spans: list[tuple[int, int]]) -> str:
    """The marked text without the blocks that are the host's.

    Where those are more than half of the text, its pages are versions of one article
    rather than articles with a passage of the host in them, and mark-up decides.
    """
    data = marked.encode()
    covered = np.zeros(len(data) + 1, np.int64)
    for a, b in spans:
        covered[a] += 1
        covered[b] -= 1
    inside, kept, at = np.cumsum(covered)[:-1] > 0, [], 0
    for block in data.split(b"\n\n"):
        if not inside[at : at + len(block)].all():
            kept.append(block.decode())
        at += len(block) + 2
    return "\n\n".join(kept) if 2 * size(kept) >= size(marked.split("\n\n")) else marked


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, others = batch.column("marked").to_pylist(), batch.column("text").to_pylist()
        for row, spans in enumerate(batch.column("spans").to_pylist()):
            if spans is not None:
                texts[row] = judged(texts[row], [(s["first"], s["upto"]) for s in spans])
            if others[row] is not None and size(others[row].split("\n\n")) <= size(texts[row].split("\n\n")):
                others[row] = None
        columns = [batch.column(c) for c in ("id", "url", "host", "mark")] + [pa.array(texts, "string"), pa.array(others, "string")]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "url", "host", "mark", "marked", "text"])


def _list_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        anchor, text, start, run = units(*_bytes_of(batch.column("body")), REPEATED)
        where = pa.array(text)
        columns = [batch.column("host").take(where), batch.column("content").take(where), pa.array(anchor), pa.array(start), pa.array(run.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "content", "anchor", "start", "run"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = _bytes_of(batch.column("body"))
        listed = batch.column("units")
        text = np.repeat(np.arange(batch.num_rows), pc.list_value_length(listed).to_numpy())
        anchor, start, run = (listed.flatten().field(c).to_numpy() for c in ("anchor", "start", "run"))
        begin = bounds[text] + start
        body = data.tobytes()
        parts = [body[a:b] for a, b in zip(begin.tolist(), (begin + run + REPEATED - 1).tolist(), strict=True)]
        digests = [int.from_bytes(hashlib.blake2b(p, digest_size=8).digest(), "little", signed=True) for p in parts]
        where = pa.array(text)
        columns = [batch.column("host").take(where), pa.array(anchor), pa.array(digests, "int64"), batch.column("content").take(where)]
        columns += [pa.array(start), pa.array(run), pa.array(parts, "binary")]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "anchor", "digest", "content", "start", "run", "piece"])


def _equal_strings(group: np.ndarray, run: np.ndarray, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings of these units, sorted by group, in the order of their suffixes: unit, place, and a number that equal ones of a group share."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    unit = np.repeat(np.arange(len(sizes)), sizes + 1)
    place = np.arange(len(unit)) - begins[unit]
    text = np.ones(len(unit), np.int64)
    text[place < sizes[unit]] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64) + 2
    last = np.concatenate((group[1:] != group[:-1], [True]))
    text[begins[last] + sizes[last]] = 0
    firsts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    order = suffix_arrays(text, np.concatenate((begins[firsts], [len(text)])))
    order = order[place[order] < run[unit[order]]]
    windows = np.lib.stride_tricks.sliding_window_view(text.astype(np.int16), REPEATED)
    same = group[unit[order[1:]]] == group[unit[order[:-1]]]
    some = np.flatnonzero(same)
    for at in range(0, len(some), 50_000):
        part = some[at : at + 50_000]
        same[part] = (windows[order[part]] == windows[order[part + 1]]).all(axis=1)
    return unit[order], place[order], np.cumsum(np.concatenate(([True], ~same))) - 1


def _shared(group: np.ndarray, low: np.ndarray, high: np.ndarray, run: np.ndarray, pieces: list[bytes]):
    """Strings of these units, sorted by group, that several pages have: unit and place."""
    unit, place, of = _equal_strings(group, run, pieces)
    starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    several = np.minimum.reduceat(low[unit], starts) < np.maximum.reduceat(high[unit], starts)
    chosen = several[of]
    return unit[chosen], place[chosen]


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found(held: list[tuple]) -> pa.RecordBatch:
        keys = [r[:2] for r in held]
        group = np.cumsum([0] + [a != b for a, b in zip(keys[1:], keys[:-1], strict=True)])
        low, high, run = (np.array([r[i] for r in held], np.int64) for i in (3, 4, 5))
        unit, place = _shared(group, low, high, run, [r[6] for r in held])
        columns = [pa.array([held[u][0] for u in unit], "string"), pa.array([held[u][1] for u in unit], "int64")]
        columns += [pa.array([held[u][2] for u in unit], "int64"), pa.array(place, "int32")]
        return pa.RecordBatch.from_arrays(columns, names=["host", "anchor", "digest", "place"])

    held, size = [], 0
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if size > SORTED and row[:2] != held[-1][:2]:
                yield found(held)
                held, size = [], 0
            held.append(row)
            size += len(row[6])
    if held:
        yield found(held)


def _unique_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for body, spans in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist(), strict=True):
            data = bytearray(body.encode())
            covered = np.zeros(len(data) + 1, np.int64)
            for at in spans:
                covered[at] += 1
                covered[at + REPEATED] -= 1
            inside, kept, at = np.cumsum(covered)[:-1] > 0, [], 0
            for block in bytes(data).split(b"\n\n"):
                words = []
                for word in block.split(b" "):
                    if not inside[at : at + len(word)].all() or not word:
                        words.append(word)
                    at += len(word) + 1
                at += 1
                kept.append(b" ".join(words).decode())
            texts.append("\n\n".join(k for k in kept if k))
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("content"), pa.array(texts, "string")], names=["host", "content", "left"])


def boilerplate_free(opened: DataFrame, wanted: DataFrame) -> DataFrame:
    """``host, content, left`` for the ``wanted`` of different ``host, content, text``: without what other texts of the host share."""
    schema = "host string, anchor bigint, digest bigint, content bigint, start bigint, run int, piece binary"
    texts = opened.select("host", "content", F.encode("text", "UTF-8").alias("body"))
    # Only units whose anchor another text of the host has, too, are cut out.
    listed = texts.mapInArrow(_list_units, "host string, content bigint, anchor bigint, start bigint, run int").withColumn("key", F.xxhash64("host", "anchor"))
    shared = listed.groupBy("key").agg(F.min("content").alias("low"), F.max("content").alias("high")).filter("low < high").select("key")
    shared = stage(shared, "shared", "zstd")
    free_shuffles(opened.sparkSession)
    kept = listed.join(shared, "key", "left_semi").groupBy("host", "content").agg(F.collect_list(F.struct("anchor", "start", "run")).alias("units"))
    found = texts.join(kept, ["host", "content"]).mapInArrow(_pieces, schema)
    found = stage(found, "pieces", "zstd")
    kinds = found.groupBy("host", "anchor", "digest").agg(
        F.min("content").alias("low"), F.max("content").alias("high"), F.max("run").alias("run"), F.min("piece").alias("piece")
    )
    counts = kinds.groupBy("host", "anchor").agg(F.count(F.lit(1)).alias("n"), F.min("low").alias("l"), F.max("high").alias("h")).filter("l < h")
    kinds = stage(kinds.join(counts.select("host", "anchor", "n"), ["host", "anchor"]), "kinds", "zstd")
    few = kinds.filter(F.col("n") <= MOST_UNITS).drop("n").repartition("host", "anchor").sortWithinPartitions("host", "anchor", "digest")
    flagged = few.mapInArrow(_sort, "host string, anchor bigint, digest bigint, place int")
    # An anchor with many units: each of its strings is counted by itself.
    many = kinds.filter(F.col("n") > MOST_UNITS).select("*", F.explode(F.sequence(F.lit(0), F.col("run") - 1)).alias("place"))
    many = many.withColumn("string", F.substring("piece", F.col("place") + 1, F.lit(REPEATED)))
    common = many.groupBy("host", "string").agg(F.min("low").alias("l"), F.max("high").alias("h")).filter("l < h").select("host", "string")
    flagged = flagged.unionByName(many.join(common, ["host", "string"]).select("host", "anchor", "digest", "place"))
    places = found.drop("piece").join(flagged, ["host", "anchor", "digest"])
    places = places.groupBy("host", "content").agg(F.collect_set((F.col("start") + F.col("place")).cast("long")).alias("places"))
    return wanted.join(places, ["host", "content"]).select("host", "content", "text", "places").mapInArrow(
        _unique_runs, "host string, content bigint, left string"
    )


def host_spans(parsed: DataFrame) -> DataFrame:
    """``host, mark, spans`` for ``host, mark, marked``: byte ranges of marked texts that are strings of the host."""
    filled = parsed.filter("marked <> ''").select("host", "mark", F.encode("marked", "UTF-8").alias("body"))
    texts = filled.select("host", "mark").distinct()
    sizes = stage(texts.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= HOST_TEXTS), "sizes")
    salt = F.pmod("mark", F.ceil(F.col("n") / GROUP)).alias("salt")
    groups = texts.join(sizes, "host").select("host", salt).groupBy("host", "salt").agg(F.count(F.lit(1)).alias("m"))

    listed = filled.mapInArrow(_list_anchors, "host string, mark bigint, anchors binary").join(sizes, "host").select("host", salt, "mark", "anchors")
    listed = listed.repartition("host", "salt").sortWithinPartitions("host", "salt", "mark")
    usual = listed.mapInArrow(_usual_anchors, "host string, anchor int").groupBy("host").agg(F.collect_set("anchor").alias("usual"))
    usual = stage(usual.join(sizes, "host"), "usual", "zstd")
    free_shuffles(parsed.sparkSession)

    schema = "host string, n bigint, salt bigint, mark bigint, anchor int, start bigint, piece binary"
    pieces = stage(filled.join(usual, "host").select("host", "n", salt, "mark", "body", "usual").mapInArrow(_usual_pieces, schema), "pieces", "zstd")
    dealt = pieces.drop("start").join(groups, ["host", "salt"]).repartition("host", "salt", "anchor").sortWithinPartitions("host", "salt", "anchor")
    counts = dealt.mapInArrow(_count_strings, "host string, anchor int, string binary, n bigint, have bigint")
    counts = counts.groupBy("host", "anchor", "string", "n").agg(F.sum("have").alias("have")).filter("have * 2 > n")
    strings = stage(counts.groupBy("host", "anchor").agg(F.collect_list("string").alias("strings")), "strings", "zstd")
    spans = pieces.join(strings, ["host", "anchor"]).mapInArrow(_spans, "host string, mark bigint, first bigint, upto bigint")
    return stage(spans.groupBy("host", "mark").agg(F.collect_set(F.struct("first", "upto")).alias("spans")), "spans", "zstd")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``id, url, text``."""
    id_type = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), url_host(F.col(url_col)).alias("host"), text_or_empty(html_col).alias("html"))
    parsed = rows.mapInArrow(_parse, f"id {id_type}, url string, host string, marked string, text string")
    parsed = stage(parsed.withColumn("mark", F.xxhash64("marked")), "parsed", "zstd")
    spans = host_spans(parsed)

    def seen(some: DataFrame) -> DataFrame:
        some = some.join(spans, ["host", "mark"], "left").select("id", "url", "host", "mark", "marked", "text", "spans")
        return some.mapInArrow(_judge, f"id {id_type}, url string, host string, mark bigint, marked string, text string")

    # Pages with no more open text than marked text are done; the others are kept for a second look.
    clear = seen(parsed).filter("text is null").select("id", "url", F.col("marked").alias("text"))
    content = F.xxhash64("mark", "text").alias("content")
    with_open = parsed.filter("text is not null")
    opened = stage(seen(with_open).filter("text is not null").select("id", "url", "host", "marked", "text", content), "open", "zstd")
    # What the host repeats shows in the open text of all its pages, those that are done, too.
    texts = with_open.join(opened.select("host").distinct(), "host", "left_semi").select("host", content, "text").distinct()
    left = boilerplate_free(texts, opened.select("host", "content", "text").distinct())
    joined = opened.join(left, ["host", "content"], "left").withColumn("left", F.coalesce("left", "text"))
    chosen = F.when(F.length("left") > F.length("marked"), F.col("left")).otherwise(F.col("marked"))
    return clear.unionByName(joined.select("id", "url", chosen.alias("text")))
