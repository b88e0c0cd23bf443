"""Merge rules as a lazily determinised finite-state transducer.

A merge vocabulary encodes a string by joining, again and again, the adjacent
pair whose join ranks first.  Two facts make a left-to-right machine of it:

* a sequence of tokens is an encoding exactly if every adjacent pair of it is
  the encoding of its own two tokens joined;
* so every prefix of the input has one last token, found from the last tokens
  of shorter prefixes.

A state is what may still matter: the last token already emitted and the
pending symbols after it.  On a symbol, the machine finds the last token at the
new position, looks which pending positions a longer token could still start
from, and emits the tokens that all of their encodings share.  No pending part
outgrows the longest token by more than one token, which bounds the lookahead.
States and transitions are made when met and kept in a table of bounded size;
dropping the table costs time, never a result.

Symbols are bytes (``bytes`` vocabularies) or characters (``str`` ones).  A
symbol that is no token stands for itself and joins nothing.
"""


#: Of inputs that meet a missing transition, one in so many makes it.
SPARE = 4


def joined(ranks, tokens, until=1):
    """The tokens after all merges: lowest rank first, leftmost among equals."""
    parts = list(tokens)
    while len(parts) > until:
        best = min(range(len(parts) - 1), key=lambda i: (ranks.get(parts[i] + parts[i + 1], 1 << 60), i))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return parts


class State:
    """``lengths``: of the last token at each pending position; ``live``: where a longer token may start."""

    __slots__ = ("lengths", "live", "next", "pending", "prev", "tail")

    def __init__(self, prev, pending, lengths, live):
        self.prev, self.pending, self.lengths, self.live = prev, pending, lengths, live
        self.next, self.tail = {}, None


class Transducer:
    """Transitions carry the sum of ``value(token)`` over the tokens they emit.

    With ids packed as bytes as values the sums are encodings, with 1 as value
    they are counts.
    """

    def __init__(self, ranks, value, zero, max_states=150_000, max_pairs=400_000):
        self.ranks, self.value, self.zero = ranks, value, zero
        # 1: a token, 2: the beginning of a longer one, 3: both.
        self.kinds = dict.fromkeys(ranks, 1)
        for t in ranks:
            for i in range(1, len(t)):
                self.kinds[t[:i]] = self.kinds.get(t[:i], 0) | 2
        self.max_states, self.max_pairs = max_states, max_pairs
        self.pairs, self.edges = {}, {}
        self.nothing = next(iter(ranks))[:0]
        # Going through bytes gives numbers; these are their symbols.
        self.single = [bytes((b,)) for b in range(256)] if self.nothing == b"" else None
        self.spared = 0
        self.reset()

    def reset(self):
        self.states = {}
        self.start = self.state(None, self.nothing, (), ())

    def state(self, prev, pending, lengths, live):
        key = (prev, pending)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State(prev, pending, lengths, live)
        return found

    def symbols(self, text):
        return [text[i:i + 1] for i in range(len(text))]

    def edge(self, token):
        """(first parts, last parts): how the token's ends grow as it is merged.

        None if merging its symbols does not give the token.  Each part comes
        with its rank; where ranks do not grow along the way, the third item is
        False and the token's neighbours are judged by merging in full.
        """
        known = self.edges.get(token, 0)
        if known == 0:
            if len(token) == 1:
                known = [(token, -1)], [(token, -1)], True
            else:
                halves = joined(self.ranks, self.symbols(token), until=2)
                known = None
                if len(halves) == 2 and token in self.ranks:
                    left, right, rank = self.edge(halves[0]), self.edge(halves[1]), self.ranks[token]
                    if left and right:
                        grows = left[2] and right[2] and rank > max(left[0][-1][1], right[1][-1][1])
                        known = left[0] + [(token, rank)], right[1] + [(token, rank)], grows
            self.edges[token] = known
        return known

    def fits(self, left, right):
        """Whether the two tokens are the encoding of their join.

        Their merges run side by side in order of rank.  They stay apart unless
        at some point the parts that touch could merge before either of them
        grows; at equal rank the pair further left goes first.
        """
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > self.max_pairs:
                self.pairs.clear()
            (_, ends, a), (starts, _, b) = self.edge(left), self.edge(right)
            if a and b:
                known, i, j, never = True, 0, 0, 1 << 60
                while known:
                    grow_left = ends[i + 1][1] if i + 1 < len(ends) else never
                    grow_right = starts[j + 1][1] if j + 1 < len(starts) else never
                    meet = self.ranks.get(ends[i][0] + starts[j][0], never)
                    if meet < grow_left and meet <= grow_right:
                        known = False
                    elif grow_left <= grow_right:
                        if grow_left == never:
                            break
                        i += 1
                    else:
                        j += 1
            else:
                known = joined(self.ranks, self.symbols(left + right)) == [left, right]
            self.pairs[left, right] = known
        return known

    def place(self, text, n, starts, lengths, prev):
        """Add the last token of ``text[:n]`` to ``lengths``; returns where a longer one may start.

        Tokens ending there begin at one of ``starts``, which go up.
        """
        kinds, edges, pairs = self.kinds, self.edges, self.pairs
        live, found = [], 0
        for start in starts:
            token = text[start:n]
            kind = kinds.get(token)
            if kind is None:
                continue
            if not found and kind & 1 and (edges.get(token) or self.edge(token)):
                left = prev if start == 0 else text[start - lengths[start - 1]:start]
                if left is None:
                    found = n - start
                else:
                    fit = pairs.get((left, token))
                    if fit or fit is None and self.fits(left, token):
                        found = n - start
            if kind & 2:
                live.append(start)
        lengths.append(found or 1)
        return live

    def step(self, state, key):
        """The transition on a symbol: (next state, value emitted)."""
        symbol = key if self.single is None else self.single[key]
        text, lengths = state.pending + symbol, list(state.lengths)
        n = len(text)
        live = self.place(text, n, [*state.live, n - 1], lengths, state.prev)
        # The last position that the encodings of all live positions and of the end share.
        shared = n
        for other in live:
            while shared != other:
                if shared > other:
                    shared -= lengths[shared - 1]
                else:
                    other -= lengths[other - 1]
            if not shared:
                break
        if shared:
            tokens = self.path(text, lengths, shared)
            live = [q - shared for q in live]
            step = self.state(tokens[-1], text[shared:], lengths[shared:], live), self.total(tokens)
        else:
            step = self.state(state.prev, text, lengths, live), self.zero
        state.next[key] = step
        return step

    def ahead(self, state, rest):
        """Value of ``rest`` read from ``state`` up to the end, without making states."""
        text, lengths, live = state.pending + rest, list(state.lengths), state.live
        for n in range(len(lengths) + 1, len(text) + 1):
            live = self.place(text, n, [*live, n - 1], lengths, state.prev)
        return self.total(self.path(text, lengths, len(text)))

    @staticmethod
    def path(text, lengths, end):
        tokens = []
        while end:
            start = end - lengths[end - 1]
            tokens.append(text[start:end])
            end = start
        return tokens[::-1]

    def total(self, tokens):
        total = self.zero
        for t in tokens:
            total += self.value(t)
        return total

    def advance(self, state, text):
        """Read ``text`` from ``state``: (state reached, value emitted)."""
        if len(self.states) > self.max_states:
            keep = state.prev, state.pending, state.lengths, state.live
            self.reset()
            state = self.state(*keep)
        total = self.zero
        for symbol in text:
            got = state.next.get(symbol)
            if got is None:
                got = self.step(state, symbol)
            state = got[0]
            if got[1]:
                total += got[1]
        return state, total

    def finish(self, state):
        """Value of the tokens still pending in ``state`` at the end of input."""
        if state.tail is None:
            state.tail = self.total(self.path(state.pending, state.lengths, len(state.pending)))
        return state.tail

    def run(self, text):
        """Value of a whole input.

        A short input makes one new state at most, and only every ``SPARE``-th that
        could does, so that the table fills with what many inputs have in common;
        what has no state yet is read without.
        """
        if len(text) > 64:
            state, total = self.advance(self.start, text)
            return total + self.finish(state)
        if len(self.states) > self.max_states:
            self.reset()
        state, total, i = self.start, self.zero, 0
        for symbol in text:
            i += 1
            got = state.next.get(symbol)
            if got is None:
                self.spared += 1
                if self.spared % SPARE:
                    return total + self.ahead(state, text[i - 1:])
                state, more = self.step(state, symbol)
                return total + more + (self.ahead(state, text[i:]) if i < len(text) else self.finish(state))
            state = got[0]
            if got[1]:
                total += got[1]
        return total + self.finish(state)
