"""Edit-aware token counts.

A document's text is cut into leaves of about ``LEAF`` characters.  Cuts lie at a single space between two other
characters that are no white space: there the pre-tokeniser always starts a new pre-token, so the leaves' tokens add up to the text's.
Over the leaves stands a segment tree with the sums of tokens and characters of every subtree, kept as two
arrays in heap order (root first, padded to a power of two).

An edit replaces a range of characters.  Only the leaves it touches are encoded again, with as many neighbours as are needed for the
boundaries to be cuts again (the characters around a cut are the context it depends on); then the sums on the way to the root are
renewed.  If the number of leaves changes, the tree above them is rebuilt from the leaves' sums, without encoding anything.

Defined results: null text counts as empty, with a tree of one empty leaf; edits outside the text are cut to it; edits of
a document are applied in the order of their start and must not overlap (an overlapping one starts where the last ended); repeated documents each
get all edits of their id; edits of unknown documents are ignored; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batch

LEAF = 512
_CUT = re.compile(r"(?<=\S) (?=\S)")


def tokenizer(path: str, pattern: str):
    """A byte-level BPE tokenizer from a file of ranks."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def public_tokenizer(name: str = "byte_bpe_50k.tiktoken"):
    import public_tokenizers

    return tokenizer(str(public_tokenizers.path(name)), public_tokenizers.PATTERN)


def leaves(text: str) -> list[str]:
    """The text cut at the first possible place after every LEAF characters."""
    out, at = [], 0
    while len(text) - at > LEAF:
        m = _CUT.search(text, at + LEAF)
        if m is None:
            break
        out.append(text[at : m.start()])
        at = m.start()
    out.append(text[at:])
    return out


class Tree:
    """Sums of tokens and characters over the leaves of one document."""

    def __init__(self, tokens: list[int], chars: list[int], n: int):
        self.tokens, self.chars, self.n = tokens, chars, n

    @classmethod
    def over(cls, tokens: list[int], chars: list[int]) -> "Tree":
        n = len(tokens)
        width = 1 << (n - 1).bit_length()
        up = [[0] * width + x + [0] * (width - n) for x in (tokens, chars)]
        for sums in up:
            for i in range(width - 1, 0, -1):
                sums[i] = sums[2 * i] + sums[2 * i + 1]
        return cls(up[0], up[1], n)

    @property
    def width(self) -> int:
        return len(self.tokens) // 2

    def leaf(self, at: int) -> tuple[int, int]:
        """(leaf that holds character ``at``, where it starts), walking down from the root."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at >= start + self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.width, start

    def set(self, leaf: int, tokens: int, chars: int) -> None:
        node = leaf + self.width
        self.tokens[node], self.chars[node] = tokens, chars
        while node > 1:
            node //= 2
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]

    def replace(self, low: int, high: int, tokens: list[int], chars: list[int]) -> None:
        """New leaves instead of those from ``low`` to before ``high``."""
        if len(tokens) == high - low:
            for i, (t, c) in enumerate(zip(tokens, chars)):
                self.set(low + i, t, c)
            return
        w = self.width
        both = [[*x[w : w + low], *new, *x[w + high : w + self.n]] for x, new in ((self.tokens, tokens), (self.chars, chars))]
        new = Tree.over(*both)
        self.tokens, self.chars, self.n = new.tokens, new.chars, new.n


def build(text: str, count) -> Tree:
    parts = leaves(text)
    return Tree.over([count(p) for p in parts], [len(p) for p in parts])


def is_cut(text: str, at: int) -> bool:
    return at in (0, len(text)) or 0 < at < len(text) - 1 and text[at] == " " and not text[at - 1].isspace() and not text[at + 1].isspace()


def edit(text: str, tree: Tree, start: int, end: int, new: str, count) -> tuple[str, int]:
    """Apply one edit to a text and its tree: (new text, characters encoded again)."""
    start, end = max(0, min(start, len(text))), max(0, min(end, len(text)))
    end = max(start, end)
    changed = text[:start] + new + text[end:]
    grown = len(changed) - len(text)
    low, left = tree.leaf(max(0, start - 1))
    high, right = tree.leaf(min(end + 1, max(0, len(text) - 1)))
    right += tree.chars[high + tree.width]
    high += 1
    # boundary context: a boundary next to the edit may be a cut no longer
    while low and not is_cut(changed, left):
        low -= 1
        left -= tree.chars[low + tree.width]
    while high < tree.n and not is_cut(changed, right + grown):
        right += tree.chars[high + tree.width]
        high += 1
    region = changed[left : right + grown]
    parts = leaves(region)
    tree.replace(low, high, [count(p) for p in parts], [len(p) for p in parts])
    return changed, len(region)


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.int64()), ("n_leaves", pa.int64()), ("n_edits", pa.int64()),
    ("chars_after", pa.int64()), ("tokens_after", pa.int64()), ("n_reencoded", pa.int64()), ("tree_tokens", pa.list_(pa.int32())), ("tree_chars", pa.list_(pa.int32())),
])
_DDL = (
    "doc_id long, n_chars long, n_tokens long, n_leaves long, n_edits long, chars_after long, tokens_after long, n_reencoded long, "
    "tree_tokens array<int>, tree_chars array<int>"
)


def counts(docs: DataFrame, load=public_tokenizer) -> DataFrame:
    """Token counts of ``docs`` (doc_id, text, edits) before and after the edits, and the trees after them.

    ``edits`` is an array of (start, end, new), offsets in characters of the text before any edit.  ``load`` makes the tokenizer in a task.
    """

    def make():
        encode = load().encode_ordinary

        def count(text: str) -> int:
            return len(encode(text))

        def fn(c):
            cols: list[list] = [[] for _ in _OUT]
            for doc, text, edits in zip(c["doc_id"], c["text"], c["edits"]):
                text = text or ""
                tree = build(text, count)
                row = [doc, len(text), tree.tokens[1], tree.n, len(edits or ())]
                shift, done, again = 0, 0, 0
                for e in sorted(edits or (), key=lambda e: (e["start"], e["end"], e["new"])):
                    start = max(e["start"], done)
                    end = max(e["end"], start)
                    size = len(text)
                    text, n = edit(text, tree, start + shift, end + shift, e["new"], count)
                    shift += len(text) - size
                    done, again = end, again + n
                for col, v in zip(cols, (*row, len(text), tree.tokens[1], again, tree.tokens, tree.chars)):
                    col.append(v)
            return dict(zip(_OUT.names, cols))

        return fn

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "edits")
    return rows.mapInArrow(by_batch(make, _OUT, 256), _DDL)


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the edits (doc_id, start, end, new) of each as an array.

    The edits of one document must fit a row, as its text does.
    """
    by = edits.where("doc_id is not null").groupBy("doc_id").agg(F.collect_list(F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "new")).alias("edits"))
    return docs.select("doc_id", "text").join(by, "doc_id", "left")


#: what a redaction replaces: mail addresses, and runs of 12 digits or more
REDACTED = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+|[0-9]{12,}"


def redactions(docs: DataFrame, mask: str = "[REDACTED]") -> DataFrame:
    """``docs`` (doc_id, text) with the edits that redact them."""
    from . import spans as S

    found = S.find(F.coalesce("text", F.lit("")), REDACTED, "redacted", 0)
    return docs.select("doc_id", "text", F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(mask).alias("new"))).alias("edits"))
