"""Main text of HTML pages by a suffix array per host.

Each page is scanned into blocks (text between block-level tags; character
references decoded, white space folded).  Elements that name themselves (by their
tag, role, id or class) as menu, header, footer, sidebar, notice, advert, form,
script, style or reader comment are left out, and where a page marks an article
(or main) element, what stands outside it.  The token streams of the remaining
blocks of a host's pages are concatenated, their suffixes are sorted by prefix
doubling to ``run_words`` words, and runs of at least that many words that stand
on several distinct pages are found.  Words covered by such runs are boilerplate
and go; the unique runs of a block stay.  A run that spans blocks only counts
where all of a block is covered, so short ones (menus, share bars) go and the
last words before a notice stay.

What counts as repeated differs by place, because articles share passages: a run
outside any marked article needs ``min_pages`` distinct pages; inside one it
needs over half of at least ``article_pages`` distinct pages of the host.  Pages
of a host with equal html count once, so copies do not remove each other.

Scale: no page is shuffled or landed; pages are parsed twice instead.  First,
each task sorts the suffixes of about ``chunk_bytes`` of HTML at a time, host by
host, and sends every run's hash (salted with its host's) and the pages that
hold it to shards by hash, so a hot host or line spreads over all shards and is
one entry per chunk.  A page of m copies counts 1 / m, which the copies'
numbers, written to the shared folder, give.  A shard adds up its runs and
writes the frequent ones there as sorted arrays.  Then each task parses its
pages again and looks their runs up in these memory-mapped arrays.  The result
depends neither on a host's size nor on how its pages are dealt.

Defined cases: null or empty html gives an empty text; a null url is a host of
its own; each repeated row comes out once; an empty table gives an empty result;
unclosed elements end with their parent; a page all of whose text stands in
elements that only may be boilerplate (such as a widget) keeps it.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import load, map_arrow, save, shared_dir
from .words import LOWER, buffers, hashes, mix64, pack, spans, unpack

RUN_WORDS, MIN_PAGES, ARTICLE_PAGES, ARTICLE_SHARE, CHUNK_BYTES = 8, 3, 20, 0.5, 2 << 20
#: bytes of html behind one shard of runs, and the most shards there are
SHARD_BYTES, MOST_SHARDS = 32 << 20, 1 << 14

# Element and attribute names of HTML
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option
p pre section select summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template svg object audio video canvas math".split())
HARD = frozenset("nav footer aside menu dialog select button head".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar".split())
COMMENTS = frozenset("comment comments commentlist respond replies disqus".split())
# names of what is boilerplate wherever it stands, and of what may also wrap a page's text
NAMES = frozenset("""ad ads advert advertisement adverts breadcrumb breadcrumbs consent cookie cookies copyright footer
login menu nav navbar navigation newsletter pagination related share sharing sidebar signup sponsor sponsored
subscribe""".split())
SOFT = frozenset("banner modal notice notices popup promo social toolbar widget".split())
HEADS = frozenset("header masthead topbar".split())
# of a compound name: first parts that tell what it is, and parts that only tell what is beside it
FIRST = frozenset("ad ads advert cookie cookies newsletter promo related share social sponsor sponsored".split())
BESIDE = frozenset("has is no not with without".split())
TOPS = frozenset("site global top".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<[!?][^>]*>""", re.S)
# one attribute: its name and, if it has one, its value (quoted or not)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

FREE, ARTICLE = 1, 2
# why an element is left out; an article inside the first two comes back, main inside the first three
SOFTLY, FORM, NAMED, GOOD = 1, 2, 3, 4


def _by_name(names: set, article: bool) -> int:
    """What the names in class and id attributes say of an element."""
    level = 0
    for name in names:
        parts = re.split("[-_]+", name)
        if len(parts) > 1 and BESIDE.isdisjoint(parts):
            if parts[0] in COMMENTS:
                return GOOD
            if parts[-1] in NAMES or parts[0] in FIRST or (not article and parts[-1] in HEADS and parts[0] in TOPS):
                level = NAMED
            elif parts[-1] in SOFT:
                level = max(level, SOFTLY)
        elif name in COMMENTS:
            return GOOD
        elif name in NAMES or (not article and name in HEADS):
            level = NAMED
        elif name in SOFT:
            level = max(level, SOFTLY)
    return level


def _zone(name: str, attributes: str, zone: tuple) -> tuple:
    """(why left out, 0 if it is not; inside an article) of an element."""
    out, article = zone
    if out == GOOD or name in HARD:
        return GOOD, article
    names: set = set()
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key = key.lower()
            if key == "hidden":
                return GOOD, article
            if key in ("class", "id"):
                names.update(value.strip("\"'").lower().split())
            elif key == "role" and set(value.strip("\"'").lower().split()) & ROLES:
                return GOOD, article
    own = _by_name(names, article) if names else 0
    if name == "main" or (name == "article" and out < NAMED):
        return (GOOD, article) if own == GOOD else (0, True)
    if name in ("html", "body"):
        return out, article
    if name == "form":
        own = max(own, FORM)
    elif name == "header" and not article:
        own = max(own, NAMED)
    return max(out, own), article


def blocks(page: str | None) -> list[tuple[str, int]]:
    """Blocks of a page in order with their place (FREE or ARTICLE); what
    structure leaves out is not among them."""
    if not page:
        return []
    found: list[tuple[str, int, int]] = []
    text: list[str] = []
    stack: list[tuple[str, tuple]] = []
    zone = (0, False)

    def close():
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if line and zone[0] <= SOFTLY:
                found.append((line, ARTICLE if zone[1] else FREE, zone[0]))

    at = 0
    while m := _TAG.search(page, at):
        if m.start() > at:
            text.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name in BLOCK:
            close()
        elif name == "br":
            text.append(" ")
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    zone = stack[i][1]
                    del stack[i:]
                    break
            continue
        if name in RAW:
            if name not in ("svg", "math") or not m[3].endswith("/"):  # only these close themselves
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in VOID:
            continue
        if name in BLOCK and any(x[0] == "p" for x in stack[-4:]):  # a block ends an open paragraph
            i = max(i for i, x in enumerate(stack) if x[0] == "p")
            zone = stack[i][1]
            del stack[i:]
        if name in ("li", "dt", "dd", "option", "tr", "td", "th") and stack and stack[-1][0] == name:
            zone = stack.pop()[1]
        stack.append((name, zone))
        zone = _zone(name, m[3], zone)
    if at < len(page):
        text.append(page[at:])
    close()
    for out, place in ((0, ARTICLE), (0, FREE), (SOFTLY, FREE)):
        kept = [(t, p) for t, p, o in found if o == out and p == place]
        if kept:
            return kept
    return []


def host_of(url):
    """Host of a url column: what stands between // and the next /, ?, # or :."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def sorted_suffixes(tokens: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by the first ``length`` tokens (prefix doubling) and the rank
    of each suffix; suffixes that agree on ``length`` tokens share a rank.
    Negative tokens are unique separators."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    n, step = len(tokens), 1
    while step < length:
        by = min(step, length - step)
        second = np.full(n, -1, np.int64)
        second[:n - by] = rank[by:]
        rank = np.unique(rank * (n + 1) + second + 1, return_inverse=True)[1].astype(np.int64)
        step += by
    return np.argsort(rank, kind="stable"), rank


def run_pages(tokens: np.ndarray, page: np.ndarray, run_words: int, weight: np.ndarray | None = None) -> np.ndarray:
    """Per token, the number of distinct pages (or the sum of their weights) that
    hold the run of ``run_words`` tokens that starts there; 0 if a separator cuts
    it.  ``page``: -1 at separators."""
    n = len(tokens)
    if n < run_words:
        return np.zeros(n, np.int64 if weight is None else np.float64)
    order, rank = sorted_suffixes(tokens, run_words)
    # pages per rank: count the changes of page inside each run of equal suffixes
    r, p = rank[order], page[order]
    wide = int(page.max()) + 2
    pairs = np.unique(r * wide + p + 1)
    add = None if weight is None else np.append(0.0, weight)[pairs % wide]
    pages = np.bincount(pairs // wide, weights=add, minlength=int(r.max()) + 1)[rank]
    ends = np.flatnonzero(page < 0)
    after = np.searchsorted(ends, np.arange(n))
    stop = np.where(after < len(ends), ends[np.minimum(after, len(ends) - 1)], n) if len(ends) else np.full(n, n)
    pages[(stop - np.arange(n) < run_words) | (page < 0)] = 0
    return pages


def spread(pages: np.ndarray, page: np.ndarray, run_words: int) -> np.ndarray:
    """Per token, the largest value of a run around it (values stand at the starts)."""
    n = len(pages)
    best = np.zeros(n, pages.dtype)
    for i in range(min(run_words, n)):
        best[i:] = np.maximum(best[i:], pages[:n - i])
    best[page < 0] = 0
    return best


def covered(tokens: np.ndarray, page: np.ndarray, run_words: int) -> np.ndarray:
    """Per token, the largest number of distinct pages that hold a run of
    ``run_words`` tokens around it.  ``page``: -1 at separators."""
    return spread(run_pages(tokens, page, run_words), page, run_words)


def run_hashes(tokens: np.ndarray, run_words: int) -> np.ndarray:
    """64-bit hash of the ``run_words`` tokens from each token on."""
    n = len(tokens)
    h = np.zeros(max(n - run_words + 1, 0), np.uint64)
    for i in range(run_words):
        h = mix64(h * np.uint64(31) + tokens[i:i + len(h)].view(np.uint64))
    return np.concatenate([h, np.zeros(n - len(h), np.uint64)])


def _laid_out(streams: list[list]):
    """The streams as tokens with a separator behind each page, none between its
    blocks: (tokens, number of each token's page (-1: separator), where the words
    stand among the tokens, words per block)."""
    raw, offsets = buffers(pa.array([t for s in streams for t in s], pa.string()))
    low = LOWER[raw]
    starts, ends, counts = spans(low, offsets)
    h = (hashes(low, starts, ends)[0] >> np.uint64(1)).astype(np.int64)
    own = np.arange(len(streams))
    last = np.cumsum([len(s) for s in streams])  # blocks up to each page's end
    upto = np.concatenate([[0], np.cumsum(counts)])[last]
    words = np.diff(upto, prepend=0)
    word_at = np.arange(len(h)) + np.repeat(own, words)
    tokens = np.empty(len(h) + len(own), np.int64)
    page = np.full(len(tokens), -1, np.int64)
    tokens[word_at] = h
    page[word_at] = np.repeat(own, words)
    tokens[upto + own] = -1 - own
    return tokens, page, word_at, counts


def _without(streams: list[list], counts: np.ndarray, whole: np.ndarray, inside: np.ndarray) -> list[str]:
    """Text of each page: its blocks without those of which every word is in
    ``whole`` and without the words in ``inside``."""
    block = np.repeat(np.arange(len(counts)), counts)
    gone = np.bincount(block, weights=whole, minlength=len(counts)) == counts
    some = np.bincount(block, weights=inside, minlength=len(counts)) > 0
    ends = np.cumsum(counts)
    out, b = [], 0
    for s in streams:
        kept = []
        for t in s:
            if some[b] and not gone[b]:
                cover = inside[ends[b] - counts[b]:ends[b]]
                t = " ".join(w for w, c in zip(t.split(" "), cover.tolist()) if not c)
            if t and not (gone[b] and counts[b]):
                kept.append(t)
            b += 1
        out.append("\n".join(kept))
    return out


def _host_hash(host: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(host.encode("utf-8", "surrogatepass"), 11))


def _page_key(host: np.uint64, page: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(page.encode("utf-8", "surrogatepass"), int(host)))


def _shard(keys: np.ndarray, width: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(width)) >> np.uint64(32)).astype(np.int64)


class _Arrays:
    """Sorted keys and their numbers, in shards of the shared folder."""

    def __init__(self, uri: str, name: str, width: int, present: frozenset):
        self.uri, self.name, self.width, self.present, self.open = uri, name, width, present, {}

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of the keys, 0 for a key that is not there."""
        distinct, inverse = np.unique(keys, return_inverse=True)
        out = np.zeros(len(distinct))
        shard = _shard(distinct, self.width)  # ascending, as the keys are
        cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            k = int(shard[i])
            if k not in self.present:
                continue
            if k not in self.open:
                if len(self.open) > 4096:  # maps that a process may hold
                    self.open.clear()
                self.open[k] = [load(f"{self.uri}/{self.name}-{x}-{k:06d}.npy") for x in ("key", "number")]
            have, number = self.open[k]
            at = np.minimum(np.searchsorted(have, distinct[i:j]), len(have) - 1)
            out[i:j] = np.where(have[at] == distinct[i:j], number[at], 0)
        return out[inverse]


def _blocks_of(keys: np.ndarray, numbers: np.ndarray, width: int) -> pa.RecordBatch:
    """Sorted keys and numbers, packed by shard."""
    cuts = np.searchsorted(_shard(keys, width), np.arange(width + 1))
    here = np.flatnonzero(np.diff(cuts)).tolist()
    return pa.RecordBatch.from_arrays(
        [pa.array(here, pa.int32()),
         pa.array([pack(np.diff(keys[cuts[k]:cuts[k + 1]], prepend=np.uint64(0)),
                        numbers[cuts[k]:cuts[k + 1]].astype(np.float64).view(np.uint64)) for k in here], pa.binary())],
        names=["shard", "block"])


def _summed(found: DataFrame, uri: str, name: str, width: int, keep) -> frozenset:
    """Add up the blocks' numbers by key, write those that ``keep`` takes as
    sorted arrays, and return the shards that have any."""
    def store(batches):
        held: dict[int, list] = {}
        for b in batches:
            for k, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(k, []).append(blob)
        for k in sorted(held):
            got = [unpack(x) for x in held.pop(k)]
            keys, where = np.unique(np.concatenate([np.cumsum(d, dtype=np.uint64) for d, _ in got]), return_inverse=True)
            total = np.bincount(where, weights=np.concatenate([n.view(np.float64) for _, n in got]))
            take = keep(total)
            if take.any():
                save(f"{uri}/{name}-key-{k:06d}.npy", keys[take])
                save(f"{uri}/{name}-number-{k:06d}.npy", total[take])
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32())], names=["shard"])

    stored = map_arrow(found.repartitionById(width, "shard"), store, "shard int")
    return frozenset(r.shard for r in stored.collect())  # a number per shard


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", run_words: int = RUN_WORDS,
              min_pages: int = MIN_PAGES, article_pages: int = ARTICLE_PAGES, article_share: float = ARTICLE_SHARE,
              chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``pages`` without its html, plus ``text`` (a ``text`` column is replaced)."""
    uri = shared_dir(pages.sparkSession, "main_text")
    rest = [c for c in pages.columns if c not in (html_col, "text")]
    names = [f"c{i}" for i in range(len(rest))]
    sent = pages.select(*[F.col(c).alias(n) for c, n in zip(rest, names)], host_of(F.col(url_col)).alias("__host"),
                        F.col(html_col).alias("__html"))
    raw = sent.select("__host", "__html")
    size = raw.agg(F.sum(F.octet_length("__html"))).first()[0] or 0
    width = int(min(MOST_SHARDS, max(16, -(-size // SHARD_BYTES))))

    def pieces(batch):
        """(rows, hosts' hashes, html) of about ``chunk_bytes`` at a time."""
        hosts = batch.column(batch.num_columns - 2).to_pylist()
        col, at = batch.column(batch.num_columns - 1), 0
        while at < len(col):
            to, held = at, 0
            while to < len(col) and (to == at or held < chunk_bytes):
                held += len(col[to].as_buffer() or b"") if col[to].is_valid else 0
                to += 1
            known: dict = {}
            own = [known.setdefault(h, _host_hash(h)) for h in hosts[at:to]]
            yield (at, to), own, [x or "" for x in col.slice(at, to - at).to_pylist()]
            at = to

    # copies: how often each html stands on its host; and every host's distinct pages
    def count_pages(batches):
        for b in batches:
            for _, own, texts in pieces(b):
                keys, n = np.unique(np.array([_page_key(h, t) for h, t in zip(own, texts)], np.uint64), return_counts=True)
                yield _blocks_of(keys, n, width)

    copies = _Arrays(uri, "copies", width, _summed(map_arrow(raw, count_pages, "shard int, block binary"), uri, "copies",
                                                   width, lambda n: n > 1))

    def weights(own, texts) -> np.ndarray:
        keys = np.array([_page_key(h, t) for h, t in zip(own, texts)], np.uint64)
        return 1.0 / np.maximum(copies.get(keys), 1.0)

    def by_host(own):
        order = np.argsort(own, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(np.array(own)[order], prepend=np.uint64(0)) != 0), len(own))
        cuts = cuts if len(cuts) > 1 and cuts[0] == 0 else np.append(0, cuts)
        return [order[i:j] for i, j in zip(cuts[:-1], cuts[1:]) if i < j]

    def count_runs(batches):
        for b in batches:
            for _, own, texts in pieces(b):
                weight, keys, total = weights(own, texts), [], []
                for rows in by_host(own):
                    host = own[rows[0]]
                    streams = [[t for t, _ in blocks(texts[i])] for i in rows.tolist()]
                    tokens, page, _, _ = _laid_out(streams)
                    held = run_pages(tokens, page, run_words, weight[rows])
                    at = np.flatnonzero(held)
                    run, first = np.unique(run_hashes(tokens, run_words)[at], return_index=True)
                    keys += [mix64(run ^ host), np.array([host], np.uint64)]  # a host's own key counts its pages
                    total += [held[at][first], np.array([weight[rows].sum()])]
                keys, total = np.concatenate(keys), np.concatenate(total)
                order = np.argsort(keys, kind="stable")
                yield _blocks_of(keys[order], total[order], width)

    # a sum of parts 1 / m is off by less than the margin
    margin = 0.01
    often = _summed(map_arrow(raw, count_runs, "shard int, block binary"), uri, "runs", width,
                    lambda n: n > min(min_pages, article_pages) - margin)
    runs = _Arrays(uri, "runs", width, often)

    def finish(batches):
        for b in batches:
            for (at, to), own, texts in pieces(b):
                found = [blocks(t) for t in texts]
                streams = [[t for t, _ in f] for f in found]
                tokens, page, word_at, counts = _laid_out(streams)
                salt = np.array(own, np.uint64)
                held = runs.get(mix64(run_hashes(tokens, run_words) ^ salt[np.maximum(page, 0)]))
                n = len(tokens)
                ends = np.flatnonzero(page < 0)
                cut = np.searchsorted(ends, np.arange(n)) != np.searchsorted(ends, np.minimum(np.arange(n) + run_words - 1, n - 1))
                held[cut | (page < 0) | (np.arange(n) + run_words > n)] = 0
                # a host's pages are at least those of its most frequent run, so hosts left out have few
                need = np.maximum(article_pages, np.floor(article_share * runs.get(salt) + margin) + 1)
                place = np.array([ARTICLE if p == ARTICLE else FREE for f in found for _, p in f], np.int64)
                block = np.repeat(np.arange(len(counts)), counts)
                least = np.where(place == ARTICLE, np.repeat(need, [len(f) for f in found]), min_pages)
                least = np.repeat(least, counts) - margin  # per word
                own_block = np.full(n, -1, np.int64)
                own_block[word_at] = block
                last = np.minimum(np.arange(n) + run_words - 1, n - 1)
                within = np.where(own_block == own_block[last], held, 0)
                whole = spread(held, page, run_words)[word_at] >= least
                inside = spread(within, page, run_words)[word_at] >= least
                text = _without(streams, counts, whole, inside)
                yield pa.RecordBatch.from_arrays([*b.slice(at, to - at).columns[:-2], pa.array(text, pa.string())],
                                                 names=[*names, "text"])

    done = map_arrow(sent, finish, sent.select(*names, F.lit("").alias("text")).schema)
    return done.select(*[F.col(n).alias(c) for c, n in zip(rest, names)], "text")
