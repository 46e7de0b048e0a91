"""Token counts that follow edits without encoding a document again.

A document's pre-tokens are gathered into leaves of about ``LEAF`` characters. A leaf
ends before a space that stands between two other characters that are not white space:
no token crosses such a cut, whatever stands beyond. Two segment trees over the
leaves, kept as arrays, hold the characters and the tokens of every subtree.

An edit replaces a range of the text. The trees lead to the leaves it touches, widened
by the characters next to it that decide on the leaves' borders; only that region is
encoded, each character once, and only sums on the way from its leaves to the root
change. If a region needs more leaves than it had, its last leaf takes the sums of those
left over, and beyond ``GROWN`` times the usual size the trees are laid out anew from
the leaves' sums, with those left over as leaves of their own.

Defined cases: a null text is an empty one; null edits are none; a range outside
the text is clipped to it; edits apply in their order, each to the text that those
before it left; repeated rows each give a row; other columns are kept, but for those named
tree and n_encoded, which are replaced.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

LEAF, GROWN = 256, 8
_CUT = re.compile(r"(?<=\S) (?=\S)")

# Fixed value: the byte-level pattern of the vocabulary.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

TREE = "size:int,chars:array<int>,tokens:array<int>"
EDITS = "array<struct<start:int,end:int,text:string>>"


@lru_cache(maxsize=2)
def ranked(path: str) -> tiktoken.Encoding:
    """The encoder of a file of base-64 tokens and their ranks."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count(path: str, text: str) -> int:
    return len(ranked(path).encode_ordinary(text))


def leaves(text: str, size: int = LEAF) -> list[str]:
    """The text cut at safe spaces into leaves of ``size`` characters or a little more."""
    out, at = [], 0
    while len(text) - at > size and (cut := _CUT.search(text, at + size)):
        out.append(text[at : cut.start()])
        at = cut.start()
    out.append(text[at:])
    return out


class Tree:
    """Sums over leaves: node 1 is the root, node k has 2k and 2k + 1, leaves from size on."""

    def __init__(self, size: int, chars: list[int], tokens: list[int]):
        self.size, self.chars, self.tokens = size, chars, tokens

    @classmethod
    def of(cls, chars: list[int], tokens: list[int]) -> Tree:
        size = 1
        while size < len(chars):
            size *= 2
        pad = [0] * (size - len(chars))
        tree = cls(size, [0] * size + chars + pad, [0] * size + tokens + pad)
        for k in range(size - 1, 0, -1):
            tree._sum(k)
        return tree

    def _sum(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def find(self, at: int) -> tuple[int, int]:
        """(leaf, where it begins) of the leaf that holds the character; the last at the end."""
        at = max(0, min(at, self.chars[1] - 1))
        k, begin = 1, 0
        while k < self.size:
            k *= 2
            if at >= begin + self.chars[k]:
                begin += self.chars[k]
                k += 1
        return k - self.size, begin

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        k = leaf + self.size
        self.chars[k], self.tokens[k] = chars, tokens
        while k > 1:
            k //= 2
            self._sum(k)


def edit(tree: Tree, text: str, start: int, end: int, new: str, path: str) -> tuple[Tree, str, int]:
    """The tree and text after an edit, and how many characters were encoded."""
    start = max(0, min(start, len(text)))
    end = max(start, min(end, len(text)))
    # a leaf's border looks one character back and one ahead: both must be untouched
    first, low = tree.find(start - 2)
    if low + 1 >= start:
        first, low = 0, 0
    last, begin = tree.find(end)
    high = begin + tree.chars[tree.size + last]
    while high < len(text) and high - 1 < end:
        last, begin = tree.find(high)
        high = begin + tree.chars[tree.size + last]
    region = text[low:start] + new + text[end:high]
    sums = [(len(part), count(path, part)) for part in leaves(region)]
    had = last - first + 1
    # no token crosses a cut, so what is over has the sums of its parts
    used = min(len(sums), had)
    over = sums[used - 1 :]
    grown = sum(c for c, _ in over), sum(t for _, t in over)
    for k, (chars, tokens) in enumerate([*sums[: used - 1], grown] + [(0, 0)] * (had - used)):
        tree.put(first + k, chars, tokens)
    text = text[:start] + new + text[end:]
    if grown[0] > GROWN * LEAF:
        tree = _spread(tree, first + used - 1, over)
    return tree, text, len(region)


def _spread(tree: Tree, leaf: int, sums: list[tuple[int, int]]) -> Tree:
    """The trees anew with one leaf replaced by several."""
    full = list(zip(tree.chars[tree.size :], tree.tokens[tree.size :]))
    full[leaf : leaf + 1] = sums
    full = [(c, t) for c, t in full if c] or [(0, 0)]
    return Tree.of([c for c, _ in full], [t for _, t in full])


def plant(text: str, path: str) -> Tree:
    parts = leaves(text)
    return Tree.of([len(p) for p in parts], [count(path, p) for p in parts])


def with_trees(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``tree``: the sums over each text's leaves."""

    def build(texts: pa.Array) -> pa.Array:
        trees = [plant(t or "", path) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [
                pa.array([t.size for t in trees], pa.int32()),
                pa.array([t.chars for t in trees], pa.list_(pa.int32())),
                pa.array([t.tokens for t in trees], pa.list_(pa.int32())),
            ],
            ["size", "chars", "tokens"],
        )

    return docs.withColumn("tree", arrow_udf(build, f"struct<{TREE}>")("text"))


def apply_edits(docs: DataFrame, path: str, edits: str = "edits") -> DataFrame:
    """``docs`` (text, tree, edits) after its edits, with ``n_encoded`` characters.

    n_tokens of a tree is ``tree_total``.
    """

    def run(texts: pa.Array, trees: pa.Array, wanted: pa.Array) -> pa.Array:
        out = []
        for text, t, todo in zip(texts.to_pylist(), trees.to_pylist(), wanted.to_pylist()):
            text, tree, encoded = text or "", Tree(t["size"], t["chars"], t["tokens"]), 0
            for e in todo or ():
                tree, text, some = edit(tree, text, e["start"], e["end"], e["text"] or "", path)
                encoded += some
            out.append(
                {
                    "text": text,
                    "tree": {"size": tree.size, "chars": tree.chars, "tokens": tree.tokens},
                    "n_encoded": encoded,
                }
            )
        kind = pa.struct(
            [
                ("text", pa.string()),
                (
                    "tree",
                    pa.struct(
                        [
                            ("size", pa.int32()),
                            ("chars", pa.list_(pa.int32())),
                            ("tokens", pa.list_(pa.int32())),
                        ]
                    ),
                ),
                ("n_encoded", pa.int64()),
            ]
        )
        return pa.array(out, kind)

    done = arrow_udf(run, f"struct<text:string,tree:struct<{TREE}>,n_encoded:bigint>")
    others = [c for c in docs.columns if c not in ("text", "tree", "n_encoded", edits)]
    # the caller's other columns travel in a struct, so they may have any name
    row = F.struct(F.lit(0).alias("text"), *(F.col(f"`{c}`") for c in others))
    return docs.select(row.alias("row"), done("text", "tree", edits).alias("done")).select(
        *(F.col(f"row.`{c}`") for c in others), "done.*"
    )


def tree_total(tree):
    """The tokens of the whole text: the root's sum."""
    return F.get(tree["tokens"], F.lit(1)).cast("long")
