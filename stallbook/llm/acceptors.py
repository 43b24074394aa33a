"""Minimal acyclic acceptors of word lists, and pairs of words one edit apart by composition.

Composed are an acceptor, a transducer that allows one edit, and the acceptor again. A state of the composition is a
state of the first acceptor, whether the edit is done, and a state of the second. Before the edit both are the same
state; after it both read the same letters, so what follows is the intersection of the two states' languages.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence


class Acceptor:
    """The smallest deterministic acceptor of some distinct words, given in order.

    Equal states are one: `arcs[s]` maps letters to states, `final[s]` says whether a word may end. `root` is the start.
    """

    def __init__(self, words: Sequence[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        # states of the last word's letters that may still grow: arcs so far, and whether a word ends
        open_arcs: list[dict[str, int]] = [{}]
        open_final = [False]
        last = ""

        def close(down_to: int) -> None:
            while len(open_arcs) > down_to + 1:
                arcs, final = open_arcs.pop(), open_final.pop()
                open_arcs[-1][last[len(open_arcs) - 1]] = self._state(known, arcs, final)

        for word in words:
            shared = 0
            while shared < len(last) and shared < len(word) and last[shared] == word[shared]:
                shared += 1
            close(shared)
            for _ in word[shared:]:
                open_arcs.append({})
                open_final.append(False)
            open_final[-1] = True
            last = word
        close(0)
        self.root = self._state(known, open_arcs[0], open_final[0])

    def _state(self, known: dict[tuple, int], arcs: dict[str, int], final: bool) -> int:
        name = (final, *arcs.items())
        state = known.get(name)
        if state is None:
            state = known[name] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return state


def one_edit_pairs(words: Acceptor, at_end: bool = True) -> Iterator[tuple[str, str]]:
    """Each pair (u, w) of accepted words once: w is u with one letter replaced by a larger one, or with one inserted.

    The edit is made at the first place where the two differ: an inserted letter is never followed by itself. Without
    `at_end`, a letter is not inserted behind the last.
    """
    arcs, final = words.arcs, words.final
    met: dict[tuple[int, int], list[str]] = {}

    def both(p: int, q: int) -> list[str]:
        """What may follow in both states: all words read from the pair on."""
        if p > q:
            p, q = q, p
        found = met.get((p, q))
        if found is None:
            found = [""] if final[p] and final[q] else []
            of_p, of_q = arcs[p], arcs[q]
            for letter in of_p if p == q else of_p.keys() & of_q.keys():
                found += [letter + rest for rest in both(of_p[letter], of_q[letter])]
            met[p, q] = found
        return found

    def edited(state: int, read: str) -> Iterator[tuple[str, str]]:
        own = list(arcs[state].items())
        for i, (c, p) in enumerate(own):
            for d, q in own[i + 1 :]:
                a, b = (c, d) if c < d else (d, c)
                for rest in both(p, q):
                    yield read + a + rest, read + b + rest
            for rest in both(state, p):
                if rest[:1] != c and (rest or at_end):
                    yield read + rest, read + c + rest
        for c, p in own:
            yield from edited(p, read + c)

    return edited(words.root, "")
