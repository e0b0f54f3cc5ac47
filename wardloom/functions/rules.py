"""Word lists and constants of the published rule-based sentiment method (Hutto & Gilbert, 2014)."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values, as published -------------------------------------------------------------

BOOST_UP = 0.293  # added by an intensifying word
BOOST_DOWN = -0.293  # added by a dampening word
BOOST_CAPS = 0.733  # added for a word in capitals among others that are not
NEGATION_SCALE = -0.74
DISTANCE_DAMPING = (1.0, 0.95, 0.9)  # for a booster one, two, three words before
NEVER_SCALE_NEAR = 1.5  # "never so good"
NEVER_SCALE_FAR = 1.25
BEFORE_CONTRAST = 0.5  # weight of what comes before "but"
AFTER_CONTRAST = 1.5  # weight of what comes after it
EXCLAMATION_STEP = 0.292
EXCLAMATION_MAX = 4
QUESTION_STEP = 0.18  # for two or three question marks
QUESTION_MAX = 0.96  # for more
NORMALIZATION = 15

INTENSIFIERS = (
    "absolutely amazingly awfully completely considerably decidedly deeply effing enormously "
    "entirely especially exceptionally extremely fabulously flipping flippin fricking frickin "
    "frigging friggin fully fucking greatly hella highly hugely incredibly intensely majorly more "
    "most particularly purely quite really remarkably so substantially thoroughly totally "
    "tremendously uber unbelievably unusually utterly very"
).split()

DAMPENERS = (
    "almost barely hardly kinda kindof kind-of less little marginally occasionally partly scarcely "
    "slightly somewhat sorta sortof sort-of"
).split()

DAMPENING_PAIRS = ("just enough", "kind of", "sort of")

NEGATIONS = (
    "aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't "
    "doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't "
    "mightn't mustn't neednt needn't never none nope nor not nothing nowhere oughtnt shant shouldnt "
    "uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont wouldnt won't "
    "wouldn't rarely seldom despite"
).split()

IDIOMS = {
    "the shit": 3.0,
    "the bomb": 3.0,
    "bad ass": 1.5,
    "yeah right": -2.0,
    "cut the mustard": 2.0,
    "kiss of death": -1.5,
    "hand to mouth": -2.0,
}

# Punctuation that is taken off when it is all that stands before or after a plain word.
EDGE_PUNCTUATION = (".", "!", "?", ",", ";", ":", "-", "'", '"', "!!", "!!!", "??", "???", "?!?", "!?!", "?!?!", "!?!?")

# --- End of fixed values --------------------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    """The word lists in force. The defaults are the published ones, for English."""

    intensifiers: tuple[str, ...] = tuple(INTENSIFIERS)
    dampeners: tuple[str, ...] = tuple(DAMPENERS)
    dampening_pairs: tuple[str, ...] = DAMPENING_PAIRS
    negations: tuple[str, ...] = tuple(NEGATIONS)
    negation_part: str = "n't"
    never: str = "never"
    never_followers: tuple[str, ...] = ("so", "this")
    least: str = "least"
    least_exceptions: tuple[str, ...] = ("at", "very")
    contrast: str = "but"
    kind_of: tuple[str, str] = ("kind", "of")
    idioms: tuple[tuple[str, float], ...] = tuple(IDIOMS.items())
