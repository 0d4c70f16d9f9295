"""Longest-match word pieces by an automaton in flat arrays.

A vocabulary within a checked size becomes two tries in one set of arrays, one
for pieces that begin a word and one for continuations. Each node knows where
matching goes on when no edge fits the next character (its failure link) and which
pieces are then final (its pops), as published for linear-time longest-match
tokenisation (Song et al., "Fast WordPiece Tokenization", 2021). A word is read
once, character by character, and all words of a batch are read side by side.

The arrays are broadcast; tasks keep a dictionary of the words they have met as
offsets into one buffer of ids, so a document is encoded in its row and neither
words nor documents are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a task remembers, and characters read at once.
REMEMBERED, READ_CHARS = 300_000, 1 << 20
_CHAR_BITS = 21


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + sizes[i] - 1`` of all i, one after another."""
    first = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum()), dtype=np.int64) + np.repeat(starts - first, sizes)


def code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all words in one array, and the length of each word."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    text = "".join(words.to_pylist())
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64), lengths


class PieceAutomaton:
    """Tries, failure links and pops of a vocabulary, as flat arrays.

    Node 0 begins a word, node 1 a continuation. ``keys`` holds
    ``node << 21 | character`` in ascending order and ``targets`` the node
    each leads to.
    """

    def __init__(self, tokens: list[str], ids: list[int], unknown: int, longest_word: int):
        #: Id of each entry; a token listed twice counts with its larger id.
        best: dict[str, int] = {}
        for t, i in zip(tokens, ids):
            best[t] = max(i, best.get(t, i))
        self.unknown, self.longest_word = unknown, longest_word
        self._grow([t for t in best if t], [best[t] for t in best if t])
        self._link()

    @classmethod
    def of(cls, state: dict) -> "PieceAutomaton":
        """From the attributes of another one; plain arrays travel as a broadcast."""
        made = cls.__new__(cls)
        made.__dict__.update(state)
        return made

    def _grow(self, tokens: list[str], ids: list[int]) -> None:
        """Both tries, one level of all tokens at a time."""
        inner = [t[2:] for t in tokens]
        texts = tokens + [x for t, x in zip(tokens, inner) if t.startswith("##") and x]
        values = np.array(
            ids + [i for t, x, i in zip(tokens, inner, ids) if t.startswith("##") and x], dtype=np.int64
        )
        node = np.zeros(len(texts), dtype=np.int64)
        node[len(tokens):] = 1
        chars, lengths = code_points(pa.array(texts, pa.large_string()))
        at = np.cumsum(lengths) - lengths
        self.depth = int(lengths.max()) if len(lengths) else 0
        parents, letters, levels, count = [np.array([-1, -1])], [np.array([0, 0])], [2], 2
        token = [np.array([-1, -1])]
        for d in range(self.depth):
            live = np.flatnonzero(lengths > d)
            keys, place = np.unique(node[live] << _CHAR_BITS | chars[at[live] + d], return_inverse=True)
            node[live] = count + place
            here = np.full(len(keys), -1, dtype=np.int64)
            done = live[lengths[live] == d + 1]
            here[node[done] - count] = values[done]
            parents.append(keys >> _CHAR_BITS)
            letters.append(keys & ((1 << _CHAR_BITS) - 1))
            token.append(here)
            count += len(keys)
            levels.append(count)
        self.parent, self.letter, self.token = map(np.concatenate, (parents, letters, token))
        self.levels = levels
        order = np.argsort(self.parent[2:] << _CHAR_BITS | self.letter[2:], kind="stable")
        self.keys = (self.parent[2:] << _CHAR_BITS | self.letter[2:])[order]
        self.targets = order + 2

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Node that each character leads to, or -1; node -1 leads nowhere."""
        if not len(self.keys):
            return np.full(len(nodes), -1, dtype=np.int64)
        wanted = nodes << _CHAR_BITS | chars
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((nodes >= 0) & (self.keys[place] == wanted), self.targets[place], -1)

    def _link(self) -> None:
        """Failure links and pops, level by level: each needs those of shorter nodes."""
        n = len(self.parent)
        self.fail = np.full(n, -1, dtype=np.int64)
        self.pop_at, self.pop_size = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        buffers, filled = [np.zeros(0, dtype=np.int64)], 0
        for low, high in zip(self.levels, self.levels[1:]):
            nodes = np.arange(low, high)
            whole = nodes[self.token[nodes] >= 0]
            # A piece that ends here is final when nothing longer fits.
            self.fail[whole] = 1
            self.pop_at[whole], self.pop_size[whole] = filled + np.arange(len(whole)), 1
            buffers.append(self.token[whole])
            filled += len(whole)
            rest = nodes[self.token[nodes] < 0]
            up, letter = self.parent[rest], self.letter[rest]
            rows, parts = [np.arange(len(rest))], [up]
            at = self.fail[up]
            # What the shorter match popped, then what its own links pop until an edge fits.
            while True:
                stuck = (at >= 0) & (self.step(at, letter) < 0)
                if not stuck.any():
                    break
                rows.append(np.flatnonzero(stuck))
                parts.append(at[stuck])
                at = np.where(stuck, self.fail[np.maximum(at, 0)], at)
            self.fail[rest] = self.step(at, letter)
            row, part = np.concatenate(rows), np.concatenate(parts)
            order = np.argsort(row, kind="stable")
            row, part = row[order], part[order]
            sizes = self.pop_size[part]
            store = np.concatenate(buffers)
            buffers = [store, store[ragged(self.pop_at[part], sizes)]]
            own = np.bincount(row, weights=sizes, minlength=len(rest)).astype(np.int64)
            self.pop_size[rest] = own
            self.pop_at[rest] = filled + np.cumsum(own) - own
            filled += int(own.sum())
        self.pops = np.concatenate(buffers)

    def split(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces of all words in one array, and how many each word has.

        A word with a place that nothing matches, or longer than the limit, is
        the unknown piece.
        """
        chars, lengths = code_points(words)
        at = np.cumsum(lengths) - lengths
        lost = lengths > self.longest_word
        node = np.zeros(len(words), dtype=np.int64)
        rows, popped = [], []

        def fall_back(of: np.ndarray, stay) -> None:
            """Follow failure links of ``of`` until ``stay`` holds; no link is no match."""
            while len(of):
                of = of[~stay(of)]
                rows.append(of)
                popped.append(node[of])
                node[of] = self.fail[node[of]]
                lost[of[node[of] < 0]] = True
                of = of[node[of] >= 0]

        for k in range(int(lengths[~lost].max()) if (~lost).any() else 0):
            live = np.flatnonzero((lengths > k) & ~lost)
            if not len(live):
                break
            letter = chars[np.minimum(at + k, len(chars) - 1)]
            target = self.step(node[live], letter[live])
            fall_back(live[target < 0], lambda w: self.step(node[w], letter[w]) >= 0)
            live = live[~lost[live]]
            node[live] = self.step(node[live], letter[live])
        fall_back(np.flatnonzero(~lost & (lengths > 0)), lambda w: node[w] == 1)
        row = np.concatenate([*rows, np.zeros(0, dtype=np.int64)])
        part = np.concatenate([*popped, np.zeros(0, dtype=np.int64)])
        order = np.argsort(row, kind="stable")
        row, part = row[order], part[order]
        kept = ~lost[row]
        row, part = row[kept], part[kept]
        sizes = self.pop_size[part]
        counts = np.bincount(row, weights=sizes, minlength=len(words)).astype(np.int64)
        counts[lost] = 1
        ids = np.full(int(counts.sum()), self.unknown, dtype=np.int64)
        place = np.cumsum(counts) - counts
        known = ~lost
        ids[ragged(place[known], counts[known])] = self.pops[ragged(self.pop_at[part], sizes)]
        return ids, counts

    def longest(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every place of every word the end of the longest match from there, and its id.

        Returns the lengths of the words and, for all their places one after
        another, ``end`` (exclusive, 0-based) and ``id``; -1 where nothing
        matches. Of a word beyond the limit only the first place is looked at.
        """
        chars, lengths = code_points(words)
        at = np.cumsum(lengths) - lengths
        places = np.where(lengths > self.longest_word, np.minimum(lengths, 1), lengths)
        start = ragged(np.zeros(len(words), dtype=np.int64), places)
        row = np.repeat(np.arange(len(words)), places)
        node, stop = (start > 0).astype(np.int64), lengths[row]
        end, found = np.full(len(row), -1, dtype=np.int64), np.full(len(row), -1, dtype=np.int64)
        live, here = np.arange(len(row)), start.copy()
        while len(live):
            live = live[here[live] < stop[live]]
            node[live] = self.step(node[live], chars[at[row[live]] + here[live]])
            live = live[node[live] >= 0]
            here[live] += 1
            hit = live[self.token[node[live]] >= 0]
            end[hit], found[hit] = here[hit], self.token[node[hit]]
        return places, end, found


class WordMemory:
    """Pieces of the words a task has met: offsets into one buffer of ids."""

    def __init__(self, automaton: PieceAutomaton):
        self.automaton = automaton
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.at = self.size = self.ids = np.zeros(0, dtype=np.int64)

    def look_up(self, words: pa.Array) -> np.ndarray:
        """Place of each distinct word in ``at`` and ``size``; new words are split first."""
        texts = words.to_pylist()
        if len(self.known) + len(texts) > REMEMBERED:
            self._forget()
        fresh = [w for w in texts if w not in self.known]
        block: list[str] = []
        size = 0
        for k, word in enumerate(fresh):
            self.known[word] = len(self.known)
            block.append(word)
            size += len(word)
            if size >= READ_CHARS or k == len(fresh) - 1:
                ids, counts = self.automaton.split(pa.array(block, pa.large_string()))
                begin = len(self.ids) + np.cumsum(counts) - counts
                self.at, self.size = np.concatenate([self.at, begin]), np.concatenate([self.size, counts])
                self.ids = np.concatenate([self.ids, ids])
                block, size = [], 0
        return np.fromiter((self.known[w] for w in texts), dtype=np.int64, count=len(texts))

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and how many each has; words longer than the limit included."""
        if not len(words):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        coded = words.dictionary_encode()
        places = self.look_up(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)]
        sizes = self.size[places]
        return self.ids[ragged(self.at[places], sizes)], sizes


def _coded(batch, memory, words, units, offsets, with_pieces) -> pa.RecordBatch:
    """``batch`` with its last column replaced by what its words, which begin at ``offsets`` for each row, are encoded to."""
    ids, sizes = memory.encode(words)
    ends = np.concatenate([[0], np.cumsum(sizes)])[offsets]
    cuts = pa.array(ends.astype(np.int32), pa.int32())
    out = [
        pa.ListArray.from_arrays(cuts, pa.array(ids.astype(np.int32))),
        pa.ListArray.from_arrays(cuts, pa.array(np.repeat(units, sizes).astype(np.int32))),
    ]
    if with_pieces is not None:
        spelled = pa.DictionaryArray.from_arrays(pa.array(ids.astype(np.int32)), with_pieces)
        out.append(pa.ListArray.from_arrays(cuts, spelled.cast(pa.string())))
    fields = [batch.schema.field(k) for k in range(batch.num_columns - 1)]
    names = [f.name for f in fields] + ["ids", "piece_units", "pieces"][: len(out)]
    return pa.RecordBatch.from_arrays([*batch.columns[:-1], *out], names)


def encoder(shared):
    """A function for ``mapInArrow``: rows with an array of ``(unit, word)`` last.

    That column is replaced by ``ids``, ``piece_units`` and, where the shared
    state holds the vocabulary's tokens, ``pieces``. All other columns pass.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, with_pieces = shared.value
        memory = WordMemory(PieceAutomaton.of(state))
        for whole in batches:
            for batch in portions(whole, pc.list_value_length, 1 << 20):
                column = batch.column(batch.num_columns - 1)
                lists = column.fill_null([]) if column.null_count else column
                offsets = lists.offsets.to_numpy().astype(np.int64)
                items = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
                units = pc.struct_field(items, 0).to_numpy(zero_copy_only=False)
                words = pc.struct_field(items, 1).cast(pa.large_string())
                yield _coded(batch, memory, words, units, offsets - offsets[0], with_pieces)

    return encode


def text_encoder(shared, by_word: bool = False):
    """:func:`encoder` for rows with an array of normalised texts last, words between spaces.

    Lines of a row's first text are its units 0, 1, 2 ...; its text k, from 1,
    is unit -k. With ``by_word`` each word is a unit, numbered through the row.
    Texts cross to the tasks as they are and are split there.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, with_pieces = shared.value
        memory = WordMemory(PieceAutomaton.of(state))
        for whole in batches:
            for batch in portions(whole, _characters, READ_CHARS * 4):
                column = batch.column(batch.num_columns - 1)
                lists = column.fill_null([]) if column.null_count else column
                row_at = lists.offsets.to_numpy().astype(np.int64)
                row_at -= row_at[0]
                lines, line_at = _split(lists.flatten(), "\n")
                words, word_at = _split(lines, " ")
                full = pc.greater(pc.binary_length(words), 0)
                words = words.filter(full)
                word_at = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])[word_at]
                of = np.repeat(np.arange(len(line_at) - 1), np.diff(line_at))
                number = np.arange(len(of)) - line_at[of]
                place = np.arange(len(line_at) - 1) - np.repeat(row_at[:-1], np.diff(row_at))
                begins = word_at[line_at[row_at]]
                if by_word:
                    units = np.arange(len(words)) - np.repeat(begins[:-1], np.diff(begins))
                else:
                    units = np.repeat(np.where(place[of] == 0, number, -place[of]), np.diff(word_at))
                yield _coded(batch, memory, words, units, begins, with_pieces)

    return encode


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: normalised texts to their words ``token`` with counts ``n``, added up over a few MB of text."""
    for whole in batches:
        for batch in portions(whole, pc.binary_length, READ_CHARS * 4):
            words, _ = _split(batch.column(batch.num_columns - 1), " ")
            counts = words.filter(pc.greater(pc.binary_length(words), 0)).value_counts()
            yield pa.RecordBatch.from_arrays([counts.field(0).cast(pa.string()), counts.field(1)], ["token", "n"])


def _split(texts: pa.Array, mark: str) -> tuple[pa.Array, np.ndarray]:
    """Parts of all texts in one array, and where those of each text begin."""
    # Copied, as some kernels misread slices that were cast.
    own = pc.fill_null(texts.take(pa.array(np.arange(len(texts), dtype=np.int64))).cast(pa.large_string()), "")
    parts = pc.split_pattern(own, mark)
    begins = parts.offsets.to_numpy().astype(np.int64)
    return parts.flatten(), begins - begins[0]


def _characters(lists: pa.Array) -> np.ndarray:
    """Bytes of all texts of each row."""
    sizes = pc.fill_null(pc.binary_length(lists.flatten()), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    return np.diff(ends[at], prepend=0)


def portions(batch: pa.RecordBatch, measure, most: int) -> Iterator[pa.RecordBatch]:
    """Whole rows of about ``most`` in what ``measure`` tells of the last column's rows."""
    sizes = measure(batch.column(batch.num_columns - 1))
    if not isinstance(sizes, np.ndarray):
        sizes = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    block = np.cumsum(sizes) // most
    cuts = np.flatnonzero(np.diff(block)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)
