"""Sentiment of one text in plain Python, from the published description, to check the Spark job."""

from __future__ import annotations

import math
import string

from wardloom.functions import rules as fixed


def words_of(text):
    found = []
    for raw in text.split():
        if len(raw) < 2:
            continue
        bare = raw.translate(str.maketrans("", "", string.punctuation))
        edges = {raw.replace(bare, "", 1)} if len(bare) > 1 and (raw.startswith(bare) or raw.endswith(bare)) else set()
        found.append(bare if edges & set(fixed.EDGE_PUNCTUATION) else raw)
    return found


def caps_bonus(valence):
    return fixed.BOOST_CAPS if valence > 0 else -fixed.BOOST_CAPS


def valence_at(words, low, i, lexicon, rules, mixed):
    word = words[i]
    if low[i] in rules.intensifiers or low[i] in rules.dampeners or low[i] not in lexicon:
        return 0.0
    if low[i] == rules.kind_of[0] and i + 1 < len(words) and low[i + 1] == rules.kind_of[1]:
        return 0.0
    value = lexicon[low[i]]
    if mixed and word.isupper():
        value += caps_bonus(value)
    for back in (1, 2, 3):
        j = i - back
        if j < 0 or low[j] in lexicon:
            continue
        if low[j] in rules.intensifiers or low[j] in rules.dampeners:
            push = fixed.BOOST_UP if low[j] in rules.intensifiers else fixed.BOOST_DOWN
            push = -push if value < 0 else push
            if mixed and words[j].isupper():
                push += caps_bonus(value)
            value += push * fixed.DISTANCE_DAMPING[back - 1]
        negated = low[j] in rules.negations or rules.negation_part in low[j]
        near_so = words[i - 1] in rules.never_followers
        if back == 2 and words[j] == rules.never and near_so:
            value *= fixed.NEVER_SCALE_NEAR
        elif back == 3 and ((words[j] == rules.never and words[i - 2] in rules.never_followers) or near_so):
            value *= fixed.NEVER_SCALE_FAR
        elif negated:
            value *= fixed.NEGATION_SCALE
        if back == 3:
            idioms = dict(rules.idioms)
            spans = [(i - 1, i), (i - 2, i), (i - 2, i - 1), (i - 3, i - 1), (i - 3, i - 2)]
            behind = [" ".join(words[a : b + 1]) for a, b in spans]
            value = next((idioms[p] for p in behind if p in idioms), value)
            for b in (i + 1, i + 2):
                if b < len(words):
                    value = idioms.get(" ".join(words[i : b + 1]), value)
            if behind[4] in rules.dampening_pairs or behind[2] in rules.dampening_pairs:
                value += fixed.BOOST_DOWN
    if i > 0 and low[i - 1] == rules.least and rules.least not in lexicon:
        if i == 1 or low[i - 2] not in rules.least_exceptions:
            value *= fixed.NEGATION_SCALE
    return value


def score(text, lexicon, rules):
    """``(neg, neu, pos, compound)``."""
    if text is None:
        return (None,) * 4
    words = words_of(text)
    if not words:
        return (0.0,) * 4
    upper = sum(w.isupper() for w in words)
    mixed = 0 < upper < len(words)
    first = {}
    for i, word in enumerate(words):
        first.setdefault(word, i)
    low = [w.lower() for w in words]
    values = [valence_at(words, low, first[w], lexicon, rules, mixed) for w in words]
    if rules.contrast in low:
        turn = low.index(rules.contrast)
        values = [v * (0.5 if k < turn else 1.5 if k > turn else 1.0) for k, v in enumerate(values)]
    emphasis = min(text.count("!"), 4) * fixed.EXCLAMATION_STEP
    asked = text.count("?")
    if asked > 1:
        emphasis += asked * fixed.QUESTION_STEP if asked <= 3 else fixed.QUESTION_MAX
    total = sum(values)
    total += emphasis if total > 0 else -emphasis if total < 0 else 0.0
    up, down = sum(v + 1 for v in values if v > 0), -sum(v - 1 for v in values if v < 0)
    neutral = sum(v == 0 for v in values)
    up, down = up + (emphasis if up > down else 0), down + (emphasis if up < down else 0)
    whole = up + down + neutral
    return (
        round(down / whole, 3),
        round(neutral / whole, 3),
        round(up / whole, 3),
        round(total / math.sqrt(total * total + fixed.NORMALIZATION), 4),
    )
