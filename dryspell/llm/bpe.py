"""BPE encoding as a bounded-lookahead streaming transducer, and incremental decoding.

A merge list fixes which pairs of tokens may stand side by side: two tokens fit
unless some merge across their boundary would have come first. Reading left to
right, each prefix of a word ends in exactly one token that fits the encoding
of what precedes it, so the transducer keeps one back pointer per position and
looks back at most one token length. How far later text can change what stands is
bounded by the merge list: a change at the front passes left only along rules of
rising rank that share a token, and :func:`sufficient_lookahead` takes the
longest such chain. Tokens that end that far behind the front are stable and leave
at once, so memory is constant however long a word is (:meth:`Bpe.stream`). A word
no longer than the lookahead can emit nothing before its end: its back pointers are
then resolved from the end, and only those that matter.

A text is one stream as well: :class:`TextEncoder` takes it in slices, cuts off the
runs between white space that are complete, and gives back their ids and decoded
bytes, which are hashed as they come. Runs have no memory of each other, so a run
met before is looked up. Only the present slice and an unfinished run are held.

Decoding maps ids to bytes and a byte-to-text state machine that holds at most
three pending bytes turns them into text, whatever chunks the ids come in
(:class:`TextDecoder`). The vocabulary's own decode, with no decoder set, joins
token strings by spaces; :class:`TextEncoder` gives that one as it goes.

Defined cases: null text is empty and has no tokens; strings of special tokens
in a text are those tokens, as in the library; an empty table gives no rows;
repeated rows are encoded one by one; other columns pass through untouched. A run
of over ``SLICE`` characters without white space is held until it ends.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import struct
import unicodedata
from collections import deque

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dryspell.llm.common import append_columns, fresh, hold

#: Fixed value: Unicode White_Space, which the vocabulary's splitting drops.
SPACES = "\t-\r \x85\xa0" + "".join(
    map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Fixed value: the vocabulary's pre-token pattern.
PRETOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+"
WORD_END = "</w>"
#: Signs that often follow a word; each is a pre-token of its own there.
SIGNS = ".,;:!?"
#: Entries of the caches of encoded runs (of words a quarter) and of tested pairs, per
#: task process (about 300 MB in all). A full cache becomes the older half and is looked
#: up once more before it goes, so frequent words stay.
RUNS, PAIRS = 400_000, 300_000
#: Symbols between two emissions of stable tokens, and characters of a text taken at once.
EMIT_EVERY = 64
SLICE = 1 << 16
FOREVER = 1 << 60


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Symbols past a boundary after which no further text can change it.

    Longest chain of rules of rising rank in which each next rule, to the left,
    wants as its right part the token that the one before takes as its left.
    """
    width = lambda t: len(t.removesuffix(WORD_END))
    best: dict[str, int] = {}
    for left, right in merges:
        reach = width(left) + best.get(right, width(right))
        best[left] = max(best.get(left, 0), reach)
    return max(best.values(), default=1)


class Bpe:
    """Encoder and decoder of one vocabulary, from its JSON text."""

    def __init__(self, source: str):
        model = json.loads(source)
        self.ids: dict[str, int] = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["model"]["merges"]]
        size = max([*self.ids.values(), *self.special.values()], default=-1) + 1
        self.text = [""] * size
        for t, i in [*self.ids.items(), *self.special.items()]:
            self.text[i] = t
        self.pair: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            left, right, whole = self.ids[a], self.ids[b], self.ids[a + b]
            self.pair[left, right] = rank
            self.made.setdefault(whole, (left, right, rank))
        self.longest = max((len(t.removesuffix(WORD_END)) for t in self.ids), default=1)
        self.lookahead = sufficient_lookahead(merges)
        self.letters = byte_letters()
        self.table = {b: c for b, c in enumerate(self.letters)}
        self.special_split = (re.compile("(" + "|".join(re.escape(s) for s in
                              sorted(self.special, key=len, reverse=True)) + ")") if self.special else None)
        # Where no special token can be in a word, a run of letters is one.
        self.plain = all(any(not c.isalpha() and c not in SIGNS for c in s) for s in self.special)
        self.pretoken = regex.compile(PRETOKEN)
        self.odd_space = re.compile("[\x1c-\x1f]")
        self.space = re.compile(f"[{SPACES}]+")
        self.spaced = [t.encode("utf-8") + b" " for t in self.text]
        self.most, self.runs, self.old_runs = RUNS, {}, {}
        self.words, self.old_words = {}, {}
        self.bytes_of: list[bytes] | None = None
        self.fit: dict[int, bool] = {}
        self.sound: dict[int, bool] = {}
        self.spine: dict[tuple[int, int], list] = {}
        # Tokens letter by letter from their last: [next letters, id of a token that encodes to itself or -1],
        # apart for tokens within and at the end of a word.
        self.inner, self.final = {}, {}
        for t, i in self.ids.items():
            here = self.final if t.endswith(WORD_END) else self.inner
            node = None
            for letter in reversed(t.removesuffix(WORD_END)):
                node = here.setdefault(letter, [{}, -1])
                here = node[0]
            if node is not None and self._alone(i):
                node[1] = i

    # Which tokens may stand side by side.
    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(token at the boundary, rank of the merge that ends it), back in merge order."""
        got = self.spine.get((token, side))
        if got is None:
            got, until, at = [], FOREVER, token
            while True:
                got.append((at, until))
                if at not in self.made:
                    break
                until = self.made[at][2]
                at = self.made[at][side]
            self.spine[token, side] = got
        return got

    def _crossed(self, left: int, right: int, before: int) -> bool:
        """Does a merge across the boundary come before rank ``before``?"""
        pair = self.pair
        for a, a_until in self._spine(left, 1):
            for b, b_until in self._spine(right, 0):
                rank = pair.get((a, b))
                # Of equal ranks the leftmost merge goes first.
                if rank is not None and rank < before and rank < a_until and rank <= b_until:
                    return True
        return False

    def _alone(self, token: int) -> bool:
        """Does the token's own text encode to it?"""
        got = self.sound.get(token)
        if got is None:
            if token not in self.made:
                got = True
            else:
                left, right, rank = self.made[token]
                got = self._alone(left) and self._alone(right) and not self._crossed(left, right, rank)
            self.sound[token] = got
        return got

    def _fits(self, left: int, right: int) -> bool:
        key = left << 32 | right
        got = self.fit.get(key)
        if got is None:
            if len(self.fit) >= PAIRS:
                self.fit.clear()
            got = self.fit[key] = not self._crossed(left, right, FOREVER)
        return got

    # One word, a string of byte letters.
    def encode_word(self, word: str) -> list[int]:
        n = len(word)
        if n == 0:
            return []
        if n > self.lookahead:
            return [t for part in self.stream(word) for t in part]
        fit = self.fit.get
        token, back = [-1] * (n + 1), [0] * (n + 1)

        def last(end: int) -> int:
            """The one token that ends the encoding of the first ``end`` symbols; earlier ones on demand."""
            here = self.inner if end < n else self.final
            begin, found = end, []
            while begin:
                node = here.get(word[begin - 1])
                if node is None:       # no token has a longer end of this kind
                    break
                begin -= 1
                here, t = node
                if t >= 0:
                    found.append((begin, t))
            while found:
                begin, t = found.pop()
                if begin:
                    left = token[begin]
                    if left < 0:
                        left = last(begin)
                    ok = fit(left << 32 | t)
                    if ok is None:
                        ok = self._fits(left, t)
                    if not ok:
                        continue
                token[end], back[end] = t, begin
                return t
            raise ValueError(f"no token ends {word[:end]!r}")

        last(n)
        out, at = [], n
        while at > 0:
            out.append(token[at])
            at = back[at]
        return out[::-1]

    def stream(self, symbols):
        """Yield lists of stable tokens of one word of any length, in constant memory.

        A token leaves once its end is the lookahead or more behind the front.
        """
        window: deque = deque(maxlen=self.longest)       # nodes of the last positions: [previous, token, position]
        recent: deque = deque(maxlen=self.longest)
        window.append([None, -1, 0])
        it = iter(symbols)
        ahead = next(it, None)
        at = 0
        while ahead is not None:
            recent.append(ahead)
            ahead = next(it, None)
            at += 1
            here = self.inner if ahead is not None else self.final
            # One position back after the other, with the letter that follows it.
            for node, letter in zip(reversed(window), reversed(recent)):
                got = here.get(letter)
                if got is None:
                    raise ValueError("no token ends a prefix of the word")
                here, t = got
                if t >= 0 and (node[1] < 0 or self._fits(node[1], t)):
                    window.append([node, t, at])
                    break
            else:
                raise ValueError("no token ends a prefix of the word")
            if at % EMIT_EVERY == 0 and ahead is not None:
                node = window[-1]
                while node is not None and node[2] > at - self.lookahead:
                    node = node[0]
                if node is not None and node[0] is not None:
                    yield self._tokens(node)
                    node[0] = None
        if at:
            yield self._tokens(window[-1])

    @staticmethod
    def _tokens(node) -> list[int]:
        out = []
        while node[0] is not None:
            out.append(node[1])
            node = node[0]
        return out[::-1]

    # Texts.
    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            got = self.old_words.get(word)
            if got is None:
                letters = word if word.isascii() and word.isalnum() else \
                    word.encode("utf-8").decode("latin-1").translate(self.table)
                ids = self.encode_word(letters)
                got = struct.pack(f"<{len(ids)}I", *ids)
            if len(word) <= 64:
                if len(self.words) >= self.most // 4:
                    self.words, self.old_words = {}, self.words
                self.words[word] = got
        return got

    def run(self, run: str) -> tuple[bytes, bytes]:
        """(ids, decoded bytes) of a run without white space."""
        got = self.old_runs.get(run)
        if got is None:
            # A word and at most a sign after it need no cutting.
            low = run.lower() if run.isascii() else run
            if not self.plain:
                ids = self._cut(run)
            elif low.isalpha() and (low.isascii() or low.islower() and unicodedata.is_normalized("NFC", low)):
                ids = self._word(low)
            elif low[-1] in SIGNS and low[:-1].isalpha() and low.isascii():
                ids = self._word(low[:-1]) + self._word(low[-1])
            else:
                ids = self._cut(run)
            got = ids, self.joined(np.frombuffer(ids, dtype="<u4").tolist())
        if len(run) <= 64:
            if len(self.runs) >= self.most:
                self.runs, self.old_runs = {}, self.runs
            self.runs[run] = got
        return got

    def _cut(self, run: str) -> bytes:
        """Ids of a run: special tokens, normalising, pre-tokens, words."""
        parts = []
        for piece in self.special_split.split(run) if self.special_split else [run]:
            if piece in self.special:
                parts.append(self.special[piece].to_bytes(4, "little"))
                continue
            # Lower-casing is by letter, so a capital sigma never becomes a final one.
            low = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
            parts += [self._word(w) for w in self.pretoken.findall(low)]
        return b"".join(parts)

    def encoder(self) -> TextEncoder:
        return TextEncoder(self)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text (unsigned 32-bit, little-endian)."""
        return np.frombuffer(b"".join([ids for ids, _ in self.encoder().all(text)]), dtype="<u4")

    def joined(self, ids: list[int]) -> bytes:
        """The tokens' strings, each with a space after it."""
        return b"".join(map(self.spaced.__getitem__, ids))

    def decode(self, ids) -> str:
        """As the library's decode without a decoder: the tokens' strings, parted by spaces."""
        return self.joined(ids.tolist() if isinstance(ids, np.ndarray) else ids)[:-1].decode("utf-8")

    def pieces(self) -> list[bytes]:
        """Bytes of each token; a word's end is a space, a special token its own text."""
        if self.bytes_of is None:
            byte = {c: b for b, c in enumerate(self.letters)}
            self.bytes_of = [
                t.encode() if t in self.special else bytes(byte[c] for c in t.removesuffix(WORD_END))
                + b" " * t.endswith(WORD_END) for t in self.text]
        return self.bytes_of

    def decoder(self) -> TextDecoder:
        return TextDecoder(self)


class TextEncoder:
    """Text in, (ids, decoded bytes) out, slice by slice; holds no more than an unfinished run.

    The decoded bytes are the token strings with a space after each: the last one
    of the text is no part of it.
    """

    def __init__(self, bpe: Bpe):
        self.bpe, self.rest = bpe, ""

    def feed(self, text: str) -> tuple[bytes, bytes]:
        """What the text makes certain: all but the run that may go on in the next slice."""
        text = self.rest + text
        end = len(text)
        split = self.bpe.space.split(text) if self.bpe.odd_space.search(text) else text.split()
        if split and text.endswith(split[-1]) and split[-1]:
            self.rest = split.pop()
        else:
            self.rest = ""
        return self._runs(split) if end else (b"", b"")

    def finish(self) -> tuple[bytes, bytes]:
        rest, self.rest = self.rest, ""
        return self._runs([rest])

    def _runs(self, split: list[str]) -> tuple[bytes, bytes]:
        get, run, got = self.bpe.runs.get, self.bpe.run, []
        for a in range(0, len(split), 4096):      # the cache may be renewed between two lots
            get = self.bpe.runs.get
            got += [get(c) or run(c) for c in split[a:a + 4096] if c]
        return b"".join([x[0] for x in got]), b"".join([x[1] for x in got])

    def all(self, text: str | None):
        """(ids, decoded bytes) of a text, slice by slice."""
        if not text:
            return
        for a in range(0, len(text), SLICE):
            yield self.feed(text[a:a + SLICE])
        yield self.finish()


class TextDecoder:
    """Ids in, text out: a state machine over the tokens' bytes with at most three of them pending."""

    def __init__(self, bpe: Bpe):
        self.piece = bpe.pieces().__getitem__
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        return self.state.decode(b"".join(map(self.piece, ids)))

    def finish(self) -> str:
        """What an unfinished character leaves."""
        return self.state.decode(b"", True)


_LOADED: dict[str, Bpe] = {}
#: By this name the encoder of a process is held over tasks.
OWNER = "bpe"


def loaded(source: str) -> Bpe:
    """One encoder per process and vocabulary, so its caches last over tasks, until one of another operator."""
    key = hashlib.sha256(source.encode()).hexdigest()
    hold(OWNER, _LOADED.clear)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(source)
    return _LOADED[key]


def encode_documents(docs: DataFrame, vocabulary_path: str, text_col: str = "text",
                     with_ids: bool = False, cached_runs: int = RUNS) -> DataFrame:
    """All columns of ``docs`` plus n_tokens, ids_sha256 and decoded_sha256.

    ``cached_runs`` bounds the memory of the caches; it does not change a result.
    ``with_ids`` adds token_ids and decoded (the text that the state machine
    gives back). The vocabulary file (of fixed size) is read here and broadcast.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    taken = docs.columns
    fields = [T.StructField(fresh("n_tokens", taken), T.LongType()),
              T.StructField(fresh("ids_sha256", taken), T.StringType()),
              T.StructField(fresh("decoded_sha256", taken), T.StringType())]
    if with_ids:
        fields += [T.StructField(fresh("token_ids", taken), T.ArrayType(T.IntegerType())),
                   T.StructField(fresh("decoded", taken), T.StringType())]

    def make():
        bpe = loaded(source.value)
        bpe.most = cached_runs

        def batch(col):
            n, ids_hash, text_hash, ids_all, texts = [], [], [], [], []
            for text in col:
                tokens, of_ids, of_text, space = 0, hashlib.sha256(), hashlib.sha256(), b""
                kept, machine, said = [], bpe.decoder(), []
                for ids, spoken in bpe.encoder().all(text.as_py()):
                    tokens += len(ids) // 4
                    of_ids.update(ids)
                    if spoken:      # the space after the text's last token is left out
                        of_text.update(space + spoken[:-1])
                        space = b" "
                    if with_ids:
                        kept.append(np.frombuffer(ids, dtype="<u4").astype(np.int32))
                        said.append(machine.feed(kept[-1].tolist()))
                n.append(tokens)
                ids_hash.append(of_ids.hexdigest())
                text_hash.append(of_text.hexdigest())
                if with_ids:
                    ids_all.append(np.concatenate(kept) if kept else np.zeros(0, np.int32))
                    texts.append("".join(said) + machine.finish())
            out = [pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
            if with_ids:
                out += [pa.array(ids_all, pa.list_(pa.int32())), pa.array(texts, pa.string())]
            return out

        return batch

    return append_columns(docs, text_col, make, fields, OWNER)
