"""Counting the tokens of a pair-merging tokenizer with a compiled transducer.

The vocabulary is compiled into a deterministic transducer over characters. Its
transitions carry the change in the number of tokens, so the sum along a text is the
number of tokens of that text. States are made when first reached:

* For every prefix of a text one token ends the prefix's own encoding. It is the only
  token that ends there, starts at some earlier place ``j``, and is compatible with the
  last token of the encoding up to ``j``.
* A state therefore holds, for each place from which a longer token may still come, the
  place in the vocabulary's trie, the last token up to it, and the number of tokens since.
* Where no token of the vocabulary reaches across, the state falls back to the initial
  one. Such places cut a text into pieces that can be counted apart.

A chunk of text acts on the incoming state as a map. Past the first such place the state
no longer depends on what came before, so a map is kept as (head, count, tail): the
characters before the first cut, the tokens between the cuts, the characters after the
last. These maps compose associatively; long texts are cut into chunks in Spark, mapped
in parallel and composed in order.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

CHUNK_CHARS = 262_144  # longer texts are counted in chunks
MAX_STATES = 400_000  # the tables are begun anew beyond this; results do not depend on it
MAX_WORDS = 400_000
SPACE = "▁"


class CountTransducer:
    """``ranks``: order of merging of every piece, lowest first. Other characters cost a
    token for each of their bytes."""

    def __init__(self, ranks: dict[str, float]):
        self.ranks = ranks
        self.names = list(ranks)
        self.children: list[dict[str, int]] = [{}]
        self.piece: list[int] = [0]  # number of the piece that ends here, from 1; else 0
        self.pairs: set[str] = set()
        for number, piece in enumerate(ranks, 1):
            node = 0
            for char in piece:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.piece.append(0)
                node = self.children[node][char]
            self.piece[node] = number
            self.pairs.update(piece[i:i + 2] for i in range(len(piece) - 1))
        assert max(map(len, ranks)) < 64 and len(ranks) < 1 << 20
        self.known: dict[tuple[int, int], bool] = {}
        self.edges: dict[tuple[str, bool], list | None] = {}
        self._begin()

    def _begin(self) -> None:
        """A state is a row of places from which a token may still come, the longest first.

        A place is a number: node of the trie, last piece before the place (0: a cut), and
        tokens since. A move is a number too: the next state and the change in tokens.
        """
        self.keys = [(64,)]
        self.number = {self.keys[0]: 0}
        self.moves: dict[int, int] = {}

    def merge(self, text: str) -> list[str]:
        """The encoding of a short text, by its definition."""
        parts = list(text)
        while True:
            best = min(((r, i) for i in range(len(parts) - 1)
                        if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None), default=None)
            if best is None:
                return parts
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def _edge(self, piece: str, right: bool) -> list[tuple[str, float, float]] | None:
        """The parts at one end of a piece while it is merged: (part, made at, gone at).

        None if the piece isn't its own encoding or its ranks don't rise on the way.
        """
        known = self.edges.get((piece, right), False)
        if known is not False:
            return known
        parts, at, edge = list(piece), float("-inf"), []
        made, current = at, parts[-1 if right else 0]
        while len(parts) > 1:
            best = min(((r, i) for i in range(len(parts) - 1)
                        if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None), default=None)
            if best is None or best[0] < at:
                edge = None
                break
            at, i = best
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            if (now := parts[-1 if right else 0]) != current:
                edge.append((current, made, at))
                made, current = at, now
        if edge is not None:
            edge.append((current, made, float("inf")))
        self.edges[piece, right] = edge
        return edge

    def _compatible(self, last: str | None, piece: str) -> bool:
        """Does the encoding of ``last + piece`` keep the two apart?"""
        after = self._edge(piece, right=False)
        before = self._edge(last, right=True) if last is not None else []
        if after is None or before is None:
            return self.merge((last or "") + piece) == ([last] if last else []) + [piece]
        i = j = 0
        # Parts at either side of the border that stand there at the same time; among equal
        # ranks the merge further left comes first.
        while i < len(before) and j < len(after):
            (left, made_left, gone_left), (right, made_right, gone_right) = before[i], after[j]
            rank = self.ranks.get(left + right)
            if rank is not None and rank < gone_left and rank <= gone_right:
                return False
            i, j = (i + 1, j) if gone_left <= gone_right else (i, j + 1)
        return True

    def _move(self, state: int, char: str) -> int:
        """Make the transition from a state on a character."""
        found, change, alive = 0, 0, []
        if char not in self.ranks:
            change = len(char.encode("utf-8", "surrogatepass"))
        else:
            children, pieces, known, across = self.children, self.piece, self.known, False
            for place in self.keys[state]:
                node, last, since = place >> 27, place >> 7 & 0xFFFFF, (place & 127) - 64
                following = children[node].get(char)
                if following is None:
                    continue
                if not (node or across):
                    last = 0  # no piece reaches across the place, so the one before doesn't matter
                across = True
                if not found and (piece := pieces[following]):
                    fits = known.get((last, piece))
                    if fits is None:
                        if len(known) > MAX_STATES:
                            known.clear()
                        names = self.names
                        fits = known[last, piece] = self._compatible(
                            names[last - 1] if last else None, names[piece - 1])
                    if fits:
                        found, change = piece, since + 1
                if children[following]:
                    alive.append((following << 20 | last) << 7 | since + 64)
        # Without a place that goes on, no token reaches across this end: the initial state.
        key = (*(p - change for p in alive), found << 7 | 64) if alive else (64,)
        following = self.number.get(key)
        if following is None:
            following = self.number[key] = len(self.keys)
            self.keys.append(key)
        move = self.moves[state << 21 | ord(char)] = following << 7 | change + 64
        return move

    def run(self, text: str) -> int:
        """Number of tokens of a text that follows a cut."""
        if len(self.keys) > MAX_STATES:
            self._begin()
        moves, state, count = self.moves, 0, 0
        for char in text:
            move = moves.get(state << 21 | ord(char))
            if move is None:
                move = self._move(state, char)
            state = move >> 7
            count += (move & 127) - 64
        return count

    def is_cut(self, left: str, right: str) -> bool:
        return left + right not in self.pairs


class _Words(dict):
    """Counts of pieces of text between cuts, each run once while it is kept."""

    def __init__(self, transducer: CountTransducer, before: str = ""):
        super().__init__()
        self.transducer, self.before = transducer, before

    def __missing__(self, word: str) -> int:
        if len(self) > MAX_WORDS:
            self.clear()
        count = self[word] = self.transducer.run(self.before + word)
        return count


class Counter:
    """Counts tokens of texts and of chunks of texts for a sentencepiece model."""

    def __init__(self, model_path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ranks = {model.id_to_piece(i): -model.get_score(i) for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        self.transducer = CountTransducer(ranks)
        self.words, self.spaced = _Words(self.transducer), _Words(self.transducer, SPACE)
        # A space inside a piece stands only at its beginning, so words are cut before it.
        assert all(SPACE not in p.lstrip(SPACE) and "\n" not in p for p in ranks)

    def escaped(self, text: str) -> str:
        return text.replace(" ", SPACE)

    def count_escaped(self, text: str) -> int:
        """Tokens of an escaped text that follows a cut."""
        lines = text.split("\n")
        total = len(lines) - 1
        for line in lines:
            if SPACE + SPACE in line:
                total += sum(map(self.words.__getitem__, re.findall(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", line)))
            elif line:
                first, *others = line.split(SPACE)
                total += self.words[first] if first else 0
                total += sum(map(self.spaced.__getitem__, others))
        return total

    def count(self, text: str) -> int:
        return self.count_escaped(SPACE + self.escaped(text)) if text else 0

    def chunk(self, text: str) -> tuple[str, int | None, str]:
        """The map of an escaped chunk: (head, count, tail), or (text, None, "") without a cut."""
        is_cut, n = self.transducer.is_cut, len(text)
        first = next((i for i in range(1, n) if is_cut(text[i - 1], text[i])), None)
        if first is None:
            return text, None, ""
        last = next(i for i in range(n - 1, 0, -1) if is_cut(text[i - 1], text[i]))
        return text[:first], self.count_escaped(text[first:last]), text[last:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two neighbouring chunks; associative."""
        if not a[0] or not b[0]:
            return a if a[0] else b
        (head, n, tail), (head2, n2, tail2) = a, b
        middle = (tail if n is not None else head) + head2
        cut = self.chunk(middle)
        if n is None and n2 is None:
            return cut
        if n is None:
            if cut[1] is None:
                return middle, n2, tail2
            return cut[0], cut[1] + self.count_escaped(cut[2]) + n2, tail2
        if n2 is None:
            if cut[1] is None:
                return head, n, middle
            return head, n + self.count_escaped(cut[0]) + cut[1], cut[2]
        return head, n + self.count_escaped(middle) + n2, tail2

    def total(self, composed: tuple) -> int:
        head, n, tail = composed
        return self.count_escaped(head) + (n or 0) + self.count_escaped(tail)


@lru_cache(2)
def _counter(model_path: str) -> Counter:
    return Counter(model_path)


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    A null or empty text has no bytes and no tokens. A null id stays null. Repeated rows
    are counted each by itself; other columns are not looked at. Empty input gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    long = F.coalesce(F.char_length("text") > chunk_chars, F.lit(False))

    def whole(texts):
        count = _counter(model_path).count
        return [(len(t.encode("utf-8", "surrogatepass")), n := count(t), n > limit) for t in texts]

    out = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    short = map_texts(rows.where(~long), whole, ["doc_id"], out)

    def chunks(texts):
        counter = _counter(model_path)
        return [(len(t.encode("utf-8", "surrogatepass")), *counter.chunk(counter.escaped(t))) for t in texts]

    def compose(batches):
        counter = _counter(model_path)
        for batch in batches:
            sizes, counts = [], []
            for maps in batch.column("maps").to_pylist():
                whole = (SPACE, None, "")
                for m in maps:
                    whole = counter.compose(whole, (m["head"], m["n"], m["tail"]))
                counts.append(counter.total(whole))
                sizes.append(sum(m["size"] for m in maps))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([n > limit for n in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    places = F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / chunk_chars).cast("int"))
    parts = (rows.where(long).withColumn("row", F.monotonically_increasing_id())
             .select("doc_id", "row", "text", F.explode(places).alias("k"))
             .select("doc_id", "row", "k", F.substring("text", F.col("k") * chunk_chars + 1,
                                                       F.lit(chunk_chars)).alias("text")))
    mapped = map_texts(parts, chunks, ["doc_id", "row", "k"],
                       "doc_id bigint, row bigint, k int, size bigint, head string, n bigint, tail string")
    grouped = mapped.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.sort_array(F.collect_list(F.struct("k", "size", "head", "n", "tail"))).alias("maps"))
    return short.unionByName(grouped.select("doc_id", "maps").mapInArrow(compose, out))
