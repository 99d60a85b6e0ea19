"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is encoded by a score-ordered agenda of adjacent symbol pairs: the pair whose concatenation is the
best-scored piece is merged first, of equal ones the leftmost, until no pair forms a piece. What is no piece
is spelt in bytes. Normalisation and decoding are the sentencepiece library's, and with ``check`` every Arrow
batch is encoded by the library as well; a difference fails the task.

No piece of such vocabularies holds a word mark after another character, so no merge crosses the start of a
word, and words are encoded apart and remembered. (A vocabulary with such pieces is encoded whole.) The new
words of a group of texts work off their agendas side by side in arrays; long runs without a word mark have
an agenda of their own, a heap.

Defined cases: a null text counts as empty and has the begin and end ids alone; repeated rows give
repeated results; an empty table gives an empty result; columns other than key and text are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabloom.llm.batches import CACHE_ENTRIES, groups, texts_of

MARK = "▁"
WORD_LENGTH = 32
NO_PIECE = float("-inf")
HASH = np.uint64(0x9E3779B97F4A7C15)
SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Runs of letters (with a word mark before them) and of other characters.
RUN = re.compile(f"{MARK}?[^\\W\\d_]+|[\\W\\d_]+?(?={MARK}?[^\\W\\d_]|$)", re.DOTALL)


class PieceEncoder:
    def __init__(self, path: str):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(library.vocab_size())
        self.raw = raw = [np.asarray([i], dtype="<u4").tobytes() for i in size]
        self.bytes = {library.id_to_piece(i): raw[i] for i in size if library.is_byte(i)}
        plain = [i for i in size if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))]
        self.ids = {library.id_to_piece(i): raw[i] for i in plain}
        self.scores = {library.id_to_piece(i): library.get_score(i) for i in plain}
        if len(self.bytes) != 256 or any(library.is_unused(i) for i in size):
            raise ValueError("the vocabulary must have byte pieces and no unused ones")
        self.by_word = not any(MARK in piece.lstrip(MARK) for piece in self.ids)
        # No piece joins a letter to another character but the mark before it.
        self.by_run = all(len({c.isalpha() for c in piece.lstrip(MARK)}) < 2 for piece in self.ids)
        self.begin, self.end = raw[library.bos_id()], raw[library.eos_id()]
        self.cache: dict[str, bytes] = {}
        self._index_pairs()

    def _index_pairs(self) -> None:
        """Every pair of symbols that forms a piece, in a hash table of arrays. Symbols are pieces and characters."""
        symbol = {piece: int.from_bytes(raw, "little") for piece, raw in self.ids.items()}
        self.characters = sorted({c for piece in self.ids for c in piece} - symbol.keys())
        symbol |= {c: len(self.raw) + n for n, c in enumerate(self.characters)}
        self.symbols = len(self.raw) + len(self.characters)
        self.of_char = np.full(0x110000, -1, dtype=np.int64)
        for text, i in symbol.items():
            if len(text) == 1:
                self.of_char[ord(text)] = i
        pairs = {}
        for piece, score in self.scores.items():
            for cut in range(1, len(piece)):
                left, right = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.symbols + right] = (score, symbol[piece])
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.last_slot = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.slot_keys = np.full(1 << bits, -1, dtype=np.int64)
        self.slot_scores = np.full((1 << bits) + 1, NO_PIECE)
        self.slot_pieces = np.full((1 << bits) + 1, -1, dtype=np.int64)
        for key, (score, piece) in pairs.items():
            slot = (key * int(HASH) % (1 << 64)) >> (64 - bits)
            while self.slot_keys[slot] >= 0:
                slot = (slot + 1) & ((1 << bits) - 1)
            self.slot_keys[slot], self.slot_scores[slot + 1], self.slot_pieces[slot + 1] = key, score, piece

    def segment(self, text: str) -> list[str]:
        """The pieces of one normalised text, by the agenda."""
        symbols = list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        scores = self.scores
        agenda: list[tuple[float, int, int, str]] = []

        def propose(left: int, right: int) -> None:
            if left >= 0 and right < n:
                piece = symbols[left] + symbols[right]
                score = scores.get(piece)
                if score is not None:
                    heapq.heappush(agenda, (-score, left, right, piece))

        for i in range(n - 1):
            propose(i, i + 1)
        while agenda:
            _, left, right, piece = heapq.heappop(agenda)
            # A pair is out of date if one of its sides has been merged since.
            if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != piece or after[left] != right:
                continue
            symbols[left], symbols[right] = piece, ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            propose(before[left], left)
            propose(left, after[left])
        return [symbol for symbol in symbols if symbol]

    def _ids(self, text: str) -> bytes:
        found = []
        for piece in self.segment(text):
            known = self.ids.get(piece)
            if known is None:
                known = b"".join(self.bytes[f"<0x{byte:02X}>"] for byte in piece.encode())
            found.append(known)
        return b"".join(found)

    def _pairs(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and symbol of the pairs that begin at the positions ``at``; no pair crosses a word."""
        left = symbols[at]
        next_at = np.minimum(at + 1, len(symbols) - 1)
        right = symbols[next_at]
        possible = (next_at > at) & (owner[at] == owner[next_at]) & (left >= 0) & (right >= 0)
        keys = np.where(possible, left * self.symbols + right, -2)
        slots = (keys.astype(np.uint64) * HASH) >> self.shift
        found = np.zeros(len(at), dtype=np.int64)  # entry 0 stands for no pair
        open_ = np.flatnonzero(possible)
        while len(open_):
            held = self.slot_keys[slots[open_]]
            hit = held == keys[open_]
            found[open_[hit]] = slots[open_[hit]] + 1
            open_ = open_[~hit & (held >= 0)]
            slots[open_] = (slots[open_] + np.uint64(1)) & self.last_slot
        return self.slot_scores[found], self.slot_pieces[found]

    def segment_words(self, words: list[str]) -> list[bytes]:
        """The ids of many words. All agendas are worked off at once: each round merges every word's best pair."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        symbols = self.of_char[points]
        symbols = np.where(symbols < 0, -2 - points.astype(np.int64), symbols)  # a character of no piece
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        scores, merged = self._pairs(symbols, owner, np.arange(len(symbols)))
        owners, pieces = [], []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.repeat(np.maximum.reduceat(scores, starts), np.diff(np.append(starts, len(symbols))))
            ended = best == NO_PIECE
            if ended.any():
                owners.append(owner[ended])
                pieces.append(symbols[ended])
                symbols, owner, scores, merged, best = (x[~ended] for x in (symbols, owner, scores, merged, best))
                if not len(symbols):
                    break
            at = np.flatnonzero(scores == best)
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]  # the leftmost of a word
            symbols[at] = merged[at]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, owner, scores, merged = (x[keep] for x in (symbols, owner, scores, merged))
            at -= np.arange(len(at))
            changed = np.concatenate([at, at[at > 0] - 1])
            scores[changed], merged[changed] = self._pairs(symbols, owner, changed)
        owner, symbols = np.concatenate(owners), np.concatenate(pieces)
        order = np.argsort(owner, kind="stable")
        owner, symbols = owner[order], symbols[order]
        spelt = set(owner[(symbols < 0) | (symbols >= len(self.raw))].tolist())
        ends = np.searchsorted(owner, np.arange(len(words)), side="right").tolist()
        raw = symbols.astype("<u4").tobytes()
        found = [raw[4 * i : 4 * j] for i, j in zip([0, *ends], ends)]
        begins = [0, *ends]
        for i in spelt:
            found[i] = b"".join([self._spelt(x) for x in symbols[begins[i] : ends[i]].tolist()])
        return found

    def _spelt(self, symbol: int) -> bytes:
        """The id of a piece, or those of the bytes of a character that is none."""
        if 0 <= symbol < len(self.raw):
            return self.raw[symbol]
        character = self.characters[symbol - len(self.raw)] if symbol >= 0 else chr(-2 - symbol)
        return b"".join(self.bytes[f"<0x{byte:02X}>"] for byte in character.encode())

    def _words(self, text: str) -> list[str]:
        """Parts of the normalised text that no piece crosses."""
        normal = self.library.normalize(text)
        if not self.by_word:
            return [normal]
        if MARK + MARK in normal or "\0" in normal:
            return SEGMENT.findall(normal)
        before, *words = normal.replace(MARK, "\0" + MARK).split("\0")  # the same, found faster
        return [before, *words] if before else words

    def _learn(self, missing: set[str]) -> None:
        """Put the ids of new words into the cache."""
        cache = self.cache
        short = [word for word in missing if len(word) <= WORD_LENGTH]
        cache.update((word, self._ids(word)) for word in missing if len(word) > WORD_LENGTH)
        mixed = []
        if self.by_word and self.by_run:  # words with other characters than letters are put together from runs
            whole = lambda word: word[1:].isalpha() or word.startswith(MARK + MARK)
            mixed = [(word, RUN.findall(word)) for word in short if not whole(word)]
            short = [word for word in short if whole(word)]
            short.extend(set(chain.from_iterable(runs for _, runs in mixed)).difference(cache, short))
        if short:
            cache.update(zip(short, self.segment_words(short)))
        cache.update((word, b"".join(map(cache.__getitem__, runs))) for word, runs in mixed)

    def encode(self, texts: list[str]) -> list[bytes]:
        """All ids of each text, with begin and end, as little-endian unsigned 32-bit integers."""
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        known = self.cache.get
        split = [self._words(text) for text in texts]
        found = [list(map(known, words)) for words in split]
        gaps = [[i for i, ids in enumerate(ids_of) if ids is None] if None in ids_of else [] for ids_of in found]
        missing = {words[i] for words, at in zip(split, gaps) for i in at}
        if missing:
            self._learn(missing)
        for words, ids_of, at in zip(split, found, gaps):
            for i in at:
                ids_of[i] = known(words[i])
        for word in missing:
            if len(word) > WORD_LENGTH:
                del self.cache[word]
        return [b"".join([self.begin, *ids_of, self.end]) for ids_of in found]


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker, whose words later tasks find again."""
    return PieceEncoder(path)


def encode(
    df: DataFrame,
    model_path: str,
    key: str = "doc_id",
    text: str = "text",
    check: bool = True,
    digest=None,
    digest_schema: str = "",
) -> DataFrame:
    """Per row: key, ``ids`` (array) and ``decoded``, the library's text of these ids.

    ``digest(ids, decoded)`` may turn both into a tuple of the columns of ``digest_schema`` within the task,
    for callers that need no token table.
    """
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model_path)
        library = encoder.library
        for batch in batches:
            texts, keys = texts_of(batch, text), batch.column(key)
            for first, last in groups(texts):
                part = texts[first:last]
                raw = [np.frombuffer(ids, dtype="<u4") for ids in encoder.encode(part)]
                ids = [array.tolist() for array in raw]
                if check and library.encode(part, add_bos=True, add_eos=True, num_threads=1) != ids:
                    raise ValueError("the agenda and the sentencepiece library differ")
                decoded = library.decode(ids, num_threads=1)
                if digest:
                    columns = [pa.array(c) for c in zip(*map(digest, raw, decoded))]
                else:
                    columns = [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names = [key, *[f"c{i}" for i in range(len(columns))]]
                yield pa.RecordBatch.from_arrays([keys[first:last], *columns], names)

    schema = digest_schema if digest else "ids array<int>, decoded string"
    named = [c.split()[0] for c in schema.split(", ")]

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch.rename_columns([key, *named])

    return df.select(key, text).mapInArrow(renamed, f"`{key}` {key_type}, {schema}")
