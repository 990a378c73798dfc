"""An Aho-Corasick automaton over a vocabulary, whose states are made when they are first reached."""

from __future__ import annotations


class State(dict):
    """The longest end of what was read that begins a vocabulary entry; leads to the next by item.

    ``ends`` holds (value, length) of every entry that ends here, the longest first.
    """

    __slots__ = ("ends", "held", "text")

    def __init__(self, held: Automaton, text):
        self.held, self.text = held, text
        values = held.values
        suffixes = (text[k:] for k in range(len(text)))
        self.ends = tuple((values[s], len(s)) for s in suffixes if s in values)

    def __missing__(self, item) -> State:
        text = self.text + (item if isinstance(item, str) else bytes((item,)))
        while text not in self.held.states and text not in self.held.prefixes and text:
            text = text[1:]
        state = self.held.states.get(text)
        if state is None:
            state = self.held.states[text] = State(self.held, text)
        self[item] = state
        return state


class Automaton:
    """Over ``values`` by entry; entries are strings, read by letter, or bytes, read by byte."""

    def __init__(self, values: dict):
        self.values = values
        self.prefixes = {entry[:k] for entry in values for k in range(1, len(entry) + 1)}
        empty = next(iter(values), "")[:0]
        self.states: dict = {}
        self.root = self.states[empty] = State(self, empty)
