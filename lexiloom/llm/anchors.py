"""Aho-Corasick anchors, built once per Python worker."""

from __future__ import annotations

from functools import lru_cache

import ahocorasick


@lru_cache(maxsize=16)
def automaton(cues: tuple[tuple[str, str], ...]) -> ahocorasick.Automaton:
    """Automaton of (cue, kind) pairs; a cue reports (kind, length)."""
    found = ahocorasick.Automaton()
    for cue, kind in cues:
        found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found
