"""A minimal acyclic automaton over byte strings that numbers its words.

Built by incremental minimisation of a sorted word list (Daciuk et al. 2000): equal
suffixes share states. Every arc carries how many words of the automaton precede the
words behind it, so that reading a word adds up to its rank in sorted order, and the
rank points into one flat array of output ids (Lucchesi and Kowaltowski 1993). All
arrays are flat numpy arrays in one file, which workers map into memory and share.
"""

from __future__ import annotations

import numpy as np


class Builder:
    """Takes words in ascending byte order."""

    def __init__(self):
        self.arcs: list[dict[int, int]] = [{}]
        self.final = [False]
        self.register: dict[tuple, int] = {}
        self.last = b""
        self.path = [0]

    def add(self, word: bytes) -> None:
        if word <= self.last and self.last:
            raise ValueError("words must ascend")
        n = 0
        while n < min(len(word), len(self.last)) and word[n] == self.last[n]:
            n += 1
        self._freeze(n)
        for b in word[n:]:
            self.arcs.append({})
            self.final.append(False)
            self.arcs[self.path[-1]][b] = len(self.arcs) - 1
            self.path.append(len(self.arcs) - 1)
        self.final[self.path[-1]] = True
        self.last = word

    def _freeze(self, depth: int) -> None:
        while len(self.path) > depth + 1:
            state = self.path.pop()
            key = (self.final[state], tuple(self.arcs[state].items()))
            kept = self.register.setdefault(key, state)
            if kept != state:
                self.arcs[self.path[-1]][self.last[len(self.path) - 1]] = kept

    def finish(self) -> dict[str, np.ndarray]:
        """Flat arrays: state s has the arcs first[s] .. first[s + 1]."""
        self._freeze(0)
        order, number, todo = [], {}, [0]
        while todo:
            s = todo.pop()
            if s not in number:
                number[s] = len(order)
                order.append(s)
                todo.extend(self.arcs[s].values())
        words: dict[int, int] = {}
        for s in self._post_order():
            words[s] = self.final[s] + sum(words[t] for t in self.arcs[s].values())
        first, label, target, skip = [0], [], [], []
        for s in order:
            before = int(self.final[s])
            for b, t in sorted(self.arcs[s].items()):
                label.append(b)
                target.append(number[t])
                skip.append(before)
                before += words[t]
            first.append(len(label))
        return {"first": np.array(first, "i4"), "label": np.array(label, "u1"), "target": np.array(target, "i4"), "skip": np.array(skip, "i4"), "final": np.array([self.final[s] for s in order], "u1")}

    def _post_order(self):
        done, stack = set(), [(0, False)]
        while stack:
            s, ready = stack.pop()
            if ready:
                yield s
            elif s not in done:
                done.add(s)
                stack.append((s, True))
                stack.extend((t, False) for t in self.arcs[s].values() if t not in done)


ARRAYS = ("first", "label", "target", "skip", "final", "offset", "ids")


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The file of an automaton that maps each word to its ids."""
    builder, words = Builder(), sorted(entries)
    for w in words:
        builder.add(w)
    parts = builder.finish()
    parts["offset"] = np.concatenate([[0], np.cumsum([len(entries[w]) for w in words])]).astype("i4") if words else np.zeros(1, "i4")
    parts["ids"] = np.array([i for w in words for i in entries[w]], "i4")
    head, body = [], b""
    for name in ARRAYS:
        a = parts[name]
        body += b"\0" * (-len(body) % 8)
        head.append((len(body), len(a), a.dtype.itemsize))
        body += a.tobytes()
    return np.array(head, "i8").tobytes() + body


class Lexicon:
    """Reads a compiled automaton; the file is mapped, not loaded."""

    def __init__(self, path: str):
        raw = np.memmap(path, "u1", "r")
        head = np.frombuffer(raw[: len(ARRAYS) * 24], "i8").reshape(-1, 3)
        start = len(ARRAYS) * 24
        for name, (at, n, size) in zip(ARRAYS, head):
            kind = {1: "u1", 4: "i4"}[int(size)]
            setattr(self, name, raw[start + at : start + at + n * size].view(kind))

    def rank(self, word: bytes) -> int:
        """The word's rank in sorted order, or -1."""
        state, at = 0, 0
        first, label, target, skip = self.first, self.label, self.target, self.skip
        for b in word:
            lo, hi = int(first[state]), int(first[state + 1])
            i = lo + int(label[lo:hi].searchsorted(b))
            if i == hi or label[i] != b:
                return -1
            at += int(skip[i])
            state = int(target[i])
        return at if self.final[state] else -1

    def get(self, word: bytes) -> list[int] | None:
        r = self.rank(word)
        return None if r < 0 else self.ids[self.offset[r] : self.offset[r + 1]].tolist()
