"""A byte-pair tokenizer compiled into a deterministic counting transducer.

Greedy merging by score has two properties that make it finite-state.  A token
sequence is a text's encoding exactly if each neighbouring pair of tokens
stays apart when encoded alone; and so each prefix of a text has one encoding,
which ends in one last token.  The transducer reads characters; its state
holds the text since the last position at which a token may still start, with
the last token and the relative token count at each of those positions.  A
transition carries the change of the token count.  States and transitions are
made when first met and shared by all texts of a worker.

Where no token holds a character pair, encodings on the two sides are
independent: the state after such a boundary does not depend on what came
before.  A chunk of text therefore acts on every entry state alike but for the
characters before its first boundary, and its state map is small: those
characters, the tokens between the first and the last boundary, and the state
and count after the last.  Maps compose associatively, so chunks are counted
independently and joined by a parallel prefix scan.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

SPACE = "▁"
MAX_STATES = 400_000
MAX_WORDS = 300_000


class Transducer:
    def __init__(self, scores: dict[str, float]):
        """scores: piece -> merge score (higher merges first); characters outside all pieces become bytes."""
        self.scores = scores
        self.chars = {p for p in scores if len(p) == 1}
        self.pairs = {p[i:i + 2] for p in scores for i in range(len(p) - 1)}
        #: beginnings that a longer piece can still complete
        self.heads = {p[:i] for p in scores for i in range(1, len(p))}
        self.longest = max(map(len, scores))
        self._apart: dict[tuple[str, str], bool] = {}
        self._reset()

    def _reset(self) -> None:
        #: per state: (text since the earliest open position, last tokens and counts there, count relative to now)
        self.states: list[tuple[str, tuple, tuple]] = [("", (None,), (0,))]
        self.ids = {self.states[0]: 0}
        self.steps: list[dict[str, tuple[int, int]]] = [{}]

    def merge(self, text: str) -> list[str]:
        """Greedy merging: the best-scored neighbouring pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def apart(self, a: str, b: str) -> bool:
        key = (a, b)
        if (known := self._apart.get(key)) is None:
            if len(self._apart) > 4 * MAX_WORDS:
                self._apart.clear()
            known = self._apart[key] = self.merge(a + b) == [a, b]
        return known

    def boundary(self, a: str, b: str) -> bool:
        """True if no token holds ``a`` followed by ``b``."""
        return a + b not in self.pairs

    def step(self, state: int, c: str) -> tuple[int, int]:
        """Next state and change of the token count."""
        if (known := self.steps[state].get(c)) is not None:
            return known
        text, last, count = self.states[state]
        if c not in self.chars:  # as bytes, apart from all around
            self.steps[state][c] = made = (0, len(c.encode("utf-8", "surrogatepass")))
            return made
        if text and text[-1] + c not in self.pairs:
            self.steps[state][c] = made = self.step(0, c)
            return made
        text += c
        n = len(text)
        for size in range(min(n, self.longest), 0, -1):
            token = text[n - size:]
            if token in self.scores and (last[n - size] is None or self.apart(last[n - size], token)):
                break
        total = count[n - size] + 1
        keep = next((i for i in range(n) if text[i:] in self.heads), n)
        starts = [text[i:] in self.heads for i in range(keep, n)]  # only there can a later token begin
        made = (text[keep:] or c, (*([] if keep < n else [None]), *(x if s else None for x, s in zip(last[keep:], starts)), token),
                (*([] if keep < n else [0]), *(x - total if s else 0 for x, s in zip(count[keep:], starts)), 0))
        to = self.ids.get(made)
        if to is None:
            to = self.ids[made] = len(self.states)
            self.states.append(made)
            self.steps.append({})
        self.steps[state][c] = (to, total)
        return to, total

    def run(self, state: int, text: str) -> tuple[int, int]:
        """Exit state and count change over any text."""
        total, steps = 0, self.steps
        for c in text:
            to = steps[state].get(c) or self.step(state, c)
            state = to[0]
            total += to[1]
        return state, total

    def tokens(self, text: str) -> int:
        """Tokens of a text between two boundaries."""
        if len(self.states) > MAX_STATES:
            self._reset()
        return self.run(0, text)[1]


@dataclass(frozen=True)
class Map:
    """How a chunk acts on any entry state.  Without a boundary inside, all of it is ``head``.

    ``tail`` is the text after the last boundary, which names the exit state."""
    head: str
    body: int = 0
    tail: str | None = None


class _Words(dict):
    """Counts of words met lately; the others are run through the transducer."""

    def __init__(self, tokens):
        super().__init__()
        self.tokens, self.older = tokens, {}

    def __missing__(self, word: str) -> int:
        n = self.older.get(word)
        if n is None:
            n = self.tokens(SPACE + word)
        if len(word) <= 64:
            if len(self) >= MAX_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = n
        return n


class Counter:
    """Counts tokens of texts through the transducer, as chunk maps or whole."""

    def __init__(self, transducer: Transducer):
        self.t = transducer
        self.memo = _Words(transducer.tokens)
        #: every single space after another character is a boundary
        self.space_splits = not any(p[1] == SPACE and p[0] != SPACE for p in transducer.pairs)

    def between(self, text: str) -> int:
        """Tokens of a text that starts and ends at boundaries."""
        if not self.space_splits or SPACE + SPACE in text:
            return self.t.tokens(text)
        first, *words = text.split(SPACE)
        return (self.t.tokens(first) if first else 0) + sum(map(self.memo.__getitem__, words))

    def chunk(self, text: str) -> Map:
        """The state map of a chunk cut anywhere."""
        first = next((i for i in range(1, len(text)) if self.t.boundary(text[i - 1], text[i])), 0)
        if not first:
            return Map(text)
        last = next(i for i in range(len(text) - 1, 0, -1) if self.t.boundary(text[i - 1], text[i]))
        return Map(text[:first], self.between(text[first:last]), text[last:])

    def compose(self, a: Map, b: Map) -> Map:
        """The map of ``a`` followed by ``b`` (associative)."""
        if not a.head:
            return b
        if not b.head:
            return a
        left = a.head if a.tail is None else a.tail
        cut = self.t.boundary(left[-1], b.head[0])
        if not cut:
            joined = left + b.head
            if a.tail is None:
                return replace(b, head=joined)
            return Map(a.head, a.body, joined) if b.tail is None else Map(a.head, a.body + self.between(joined) + b.body, b.tail)
        if a.tail is None:
            return Map(left, 0, b.head) if b.tail is None else Map(left, self.between(b.head) + b.body, b.tail)
        body = a.body + self.between(left)
        return Map(a.head, body, b.head) if b.tail is None else Map(a.head, body + self.between(b.head) + b.body, b.tail)

    def scan(self, maps: list[Map]) -> list[Map]:
        """Inclusive prefix scan in logarithmically many rounds of independent compositions."""
        if len(maps) < 2:
            return maps
        pairs = self.scan([self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])])
        out = [maps[0]]
        for i in range(1, len(maps)):
            out.append(pairs[i // 2] if i % 2 else self.compose(pairs[i // 2 - 1], maps[i]))
        return out

    def finish(self, m: Map) -> int:
        """Tokens when the text ends after this map, entered at the start state."""
        return (self.between(m.head) if m.head else 0) + m.body + (self.between(m.tail) if m.tail else 0)
