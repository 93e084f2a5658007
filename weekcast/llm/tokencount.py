"""Token counts by a compiled finite-state transducer.

The tokenizer merges the best-scored adjacent pair first.  Two facts make that finite-state: a prefix
of a text has one last token, found from the last tokens of shorter prefixes by asking whether a
pair of tokens stays apart when merged alone; and only positions whose remainder is still the start
of some piece can matter later.  A state is those positions with their last tokens and counts
relative to the current end.  Each transition is annotated with the change of the token count, so a
text's count is the sum along its path.  States and transitions are compiled when first met.

Texts are cut into chunks.  A chunk's state map is constant from its first synchronising character
on (white space after a word, or a character outside the vocabulary), so all chunks run side by side
in numpy from there; each lead, the part before that character, is then run from its predecessor's
end state, one chunk a pass.  Maps are not composed: a long text without white space runs serially.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.session import ship_package

#: Characters per chunk, characters handled at once, and cells of the transition table.  The table is
#: compiled anew when it is full.  None of them changes a count.
CHUNK = 512
BATCH = 1 << 21
CELLS = 24_000_000
_BLANK = "▁"


class MergeRules:
    """The pieces of a sentencepiece BPE model and what they do when merged alone."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
                self.score[sp.id_to_piece(i)] = sp.get_score(i)
        runs = {p for p in self.score if set(p) == {_BLANK}}
        if any(_BLANK in p[1:] for p in self.score if p not in runs):
            raise ValueError("pieces with white space inside are not supported")
        #: Pieces of a run of white space alone, by its length; one period long.
        self.run = max(map(len, runs), default=1)
        self.chars = {p for p in self.score if len(p) == 1}
        self._apart: dict[tuple[str, str], bool] = {}
        self.step: dict[str, dict[str, str]] = {"": {}}
        self.whole = set()
        for p in self.score:
            if p in runs and len(p) > 1:
                continue
            if len(p) == 1 or self.merge(p) == [p]:
                self.whole.add(p)
                for n in range(len(p)):
                    self.step.setdefault(p[:n], {})[p[n]] = p[:n + 1]
                self.step.setdefault(p, {})
        alone = [len(self.merge(_BLANK * n)) for n in range(3 * self.run + 1)]
        if any(alone[n + self.run] != alone[n] + 1 for n in range(1, 2 * self.run + 1)):
            raise ValueError("the pieces of white-space runs don't repeat after the longest one")
        #: By length modulo the period: what the run's last blank adds to the count.
        self.last_blank = {n: alone[n] - alone[n - 1] for n in range(1, self.run + 1)}

    def merge(self, text: str) -> list[str]:
        """Pieces of a text: the best pair first, the leftmost among equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def apart(self, left: str, right: str) -> bool:
        """Whether two neighbouring pieces stay as they are."""
        got = self._apart.get((left, right))
        if got is None:
            if len(self._apart) > 2_000_000:
                self._apart.clear()
            got = self._apart[left, right] = self.merge(left + right) == [left, right]
        return got


# A state inside a word: (longest live remainder, ((length, last token, count), ...)), the positions
# whose remainder of that length is the start of a piece; counts are relative to the current end.
_FRESH = ("", ((0, "", 0),))


class Transducer:
    def __init__(self, path: str):
        self.rules = MergeRules(path)
        self.kind = np.zeros(0x110000, np.int32)   # class of a character; 0: not met yet
        self.letters = [""]
        self.width = 64
        self._reset([])

    # -- compilation ---------------------------------------------------------------------------
    def _reset(self, keep: list) -> list[int]:
        self.states: list = []
        self.number: dict = {}
        rows = max(256, CELLS // self.width // 64)
        self.next = np.full((rows, self.width), -1, np.int32)
        self.delta = np.zeros((rows, self.width), np.int8)
        self._intern(_FRESH)
        return [self._intern(k) for k in keep]

    def _intern(self, key) -> int:
        n = self.number.get(key)
        if n is None:
            n = self.number[key] = len(self.states)
            self.states.append(key)
            if n >= len(self.next):
                more = len(self.next)
                self.next = np.concatenate([self.next, np.full((more, self.width), -1, np.int32)])
                self.delta = np.concatenate([self.delta, np.zeros((more, self.width), np.int8)])
        return n

    def _word(self, state, c: str, first_blank: int = 1):
        """A word state after one more character, and the change of the count."""
        step, whole = self.rules.step, self.rules.whole
        longest, live = state
        found, rest = None, []
        for n, last, count in live:                       # longest remainder first
            grown = step[longest[len(longest) - n:]].get(c)
            if grown is None:
                continue
            if grown in whole and found is None and (not last or self.rules.apart(last, grown)):
                found = grown, count + (first_blank if grown == _BLANK else 1)
            if step[grown]:
                rest.append((n + 1, last, count))
        token, change = found
        rest = tuple((n, last, count - change) for n, last, count in rest) + ((0, token, 0),)
        text = longest + c
        return (text[len(text) - rest[0][0]:], rest), change

    def _move(self, key, c: str):
        """The state after ``c`` and the change of the count.  Runs of white space are states by
        their length modulo the longest run piece: a run merges after everything else, so its last
        blank first belongs to the word behind it."""
        rules = self.rules
        if c == _BLANK:
            n = key[1] % rules.run + 1 if key[0] is None else 1
            return (None, n), rules.last_blank[n]
        if c not in rules.chars:
            return _FRESH, len(c.encode())                # bytes instead of a piece
        if key[0] is None:
            # a first token that is the blank alone joins the run, at the price of the run's last blank
            return self._word(self._word(_FRESH, _BLANK, rules.last_blank[key[1]])[0], c)
        return self._word(key, c)

    def _compile(self, states: np.ndarray, kinds: np.ndarray):
        for s, k in zip(states.tolist(), kinds.tolist()):
            key, change = self._move(self.states[s], self.letters[k])
            n = self._intern(key)
            self.next[s, k], self.delta[s, k] = n, change

    def _classes(self, cp: np.ndarray) -> np.ndarray:
        kind = self.kind[cp]
        if not kind.all():
            for c in np.unique(cp[kind == 0]).tolist():
                letter = _BLANK if c == 0x20 else chr(c)
                if letter not in self.rules.chars and letter != _BLANK:
                    letter = {1: "\n", 2: "\u0080", 3: "￿", 4: "\U0010ffff"}[len(letter.encode())]
                    if letter in self.rules.chars:
                        raise ValueError("the stand-in for characters outside the vocabulary is inside it")
                if letter not in self.letters:
                    self.letters.append(letter)
                self.kind[c] = self.letters.index(letter)
            if len(self.letters) > self.width:
                while len(self.letters) > self.width:
                    self.width *= 2
                self._reset([])
            kind = self.kind[cp]
        return kind

    # -- runs ----------------------------------------------------------------------------------
    def _lanes(self, kind, at, size, state):
        """End state and count of each lane: ``size`` characters from ``at`` on, from ``state``."""
        order = np.argsort(-size, kind="stable")
        at, size, state = at[order], size[order], state[order].copy()
        count = np.zeros(len(at), np.int64)
        active = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right") if len(size) else []
        for i, a in enumerate(np.asarray(active).tolist()):
            k = kind[at[:a] + i]
            cell = state[:a] * self.width + k
            new = self.next.ravel().take(cell)
            if (new < 0).any():
                miss = np.unique(cell[new < 0])
                if (len(self.states) + len(miss)) * self.width > CELLS:
                    used, where = np.unique(state, return_inverse=True)
                    state = np.array(self._reset([self.states[s] for s in used.tolist()]), np.int64)[where]
                    cell = state[:a] * self.width + k
                    miss = np.unique(cell)
                self._compile(miss // self.width, miss % self.width)
                new = self.next.ravel().take(cell)
            count[:a] += self.delta.ravel().take(cell)
            state[:a] = new
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], count[back]

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        group, held = [], 0
        for i, t in enumerate(texts):
            if held and held + len(t) > BATCH:
                out[group] = self._counts([texts[j] for j in group])
                group, held = [], 0
            if t:
                group.append(i)
                held += len(t) + 1
        if group:
            out[group] = self._counts([texts[j] for j in group])
        return out

    def _counts(self, texts: list[str]) -> np.ndarray:
        # the library puts one blank before a text
        cp = np.frombuffer("".join([" " + t for t in texts]).encode("utf-32-le"), np.uint32)
        kind = self._classes(cp)
        size = np.array([len(t) + 1 for t in texts])
        parts = -(-size // CHUNK)
        doc = np.repeat(np.arange(len(texts)), parts)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
        at = (np.cumsum(size) - size)[doc] + nth * CHUNK
        length = np.minimum(CHUNK, size[doc] - nth * CHUNK)
        # characters after which the state does not depend on what came before
        blank = self.kind[0x20] or -1
        outside = np.array([i > 0 and c not in self.rules.chars for i, c in enumerate(self.letters)])
        sync = outside[kind]
        sync[1:] |= (kind[1:] == blank) & (kind[:-1] != blank)
        spots = np.append(np.flatnonzero(sync), len(cp) + CHUNK)
        # one blank may follow another across a chunk's start: look from its second character on
        first = spots[np.searchsorted(spots, at + 1)]
        lead = np.where(nth == 0, 0, np.minimum(first - at, length))
        end, count = self._lanes(kind, at + lead, length - lead, np.zeros(len(at), np.int64))
        keys = None
        todo = np.flatnonzero(lead > 0)
        ready = lead < length                              # the end state is known
        while len(todo):
            now = todo[ready[todo - 1]]
            before = self.states
            start = end[now - 1]
            e, c = self._lanes(kind, at[now], lead[now], start)
            if self.states is not before:                  # compiled anew meanwhile: run this text group again
                keys = True
                break
            count[now] += c
            whole = lead[now] == length[now]
            end[now[whole]] = e[whole]
            ready[now] = True
            todo = todo[~np.isin(todo, now)]
        if keys:
            return self._counts(texts) if len(texts) == 1 else np.concatenate(
                [self._counts(texts[:len(texts) // 2]), self._counts(texts[len(texts) // 2:])])
        return np.bincount(doc, weights=count, minlength=len(texts)).astype(np.int64)


@functools.cache
def transducer(path: str) -> Transducer:
    """One transducer per worker and file."""
    return Transducer(path)


def _count(path: str):
    def run(batches):
        machine = transducer(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(
                machine.counts([t or "" for t in texts]))], names=["key", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, model: str, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) per row; null texts count as empty, which has no tokens.

    ``model``: path of a sentencepiece BPE model with byte fallback.  Rows stay where the scan put
    them; repeated rows and keys are counted one by one.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.mapInArrow(_count(model), "key long, n_bytes long, n_tokens long") \
        .select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
