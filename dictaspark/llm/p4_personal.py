"""Personal information in free text: a semi-Markov conditional random field over candidate spans.

Method: lexical patterns propose candidate segments (written and spelled-out addresses,
numbers, streets and names). Whole-span features score every segment; dynamic programming
over the segments, each of bounded length, picks the best non-overlapping set with its
types, everything between being plain text of score 0. Weights are the maximum of the
conditional likelihood (forward and backward over the lattice) of all texts, labelled by
distant rules, and of generated sentences; the words that count as common are counted over
all texts too. Segments are proposed once for each text and kept; the likelihood of a text
is the product over its runs of overlapping segments, so equal runs are counted and the
slopes of the weights are summed over all partitions, in whole numbers, whose sums do not
depend on the partitions. Every row and whole texts are decoded. Fillers and stuttered
words are skipped by the matcher; placeholders replace the original characters.

Defined results: null text stays null and holds nothing; empty text stays empty; very
long texts are read whole; repeated rows give repeated redactions, and the found table
has one row for each row id, field and kind; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import random
import re
from bisect import bisect_right
from collections import Counter, deque
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dictaspark.session import checkpoint, ship, spread

KINDS = ("email", "phone", "id_number", "street_address", "person_name")
GENERATED = 4000
BALANCE = 3000  # all texts together weigh as much as so many beside the generated sentences
OPEN = 1 << 16  # weights that the features made of any word share by hash
DECAY = 0.5  # one over the variance of the weights' prior
STEPS = 60
UNIT = 1 << 30
PARTS = 20_000  # of one block of training data
NO_CASE_DOMAINS = ("example.com", "example.org")

FILLERS = frozenset("um uh er hmm euh bah ben hum".split())
TITLES = frozenset("mr mrs ms miss dr doctor sir madam professor prof docteur madame monsieur mme mademoiselle mlle maître".split())
TLDS = frozenset("com org net edu gov info io eu fr uk de ch be ca us it es nl test example local invalid".split())
DIGIT_EN = "zero oh o one two three four five six seven eight nine double triple".split()
NUMBER_EN = DIGIT_EN[3:12] + "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred".split()
NUMBER_FR = "zéro un une deux trois quatre cinq six sept huit neuf dix onze douze treize quatorze quinze seize vingt vingts trente quarante cinquante soixante septante huitante octante nonante cent cents".split()
STREET_EN = "street st lane road rd avenue ave close court crescent drive way place square row terrace gardens hill grove mews walk boulevard parade".split()
STREET_FR = "rue avenue boulevard bd impasse quai place allée montée chemin route cours square passage sentier ruelle esplanade faubourg".split()
PAIR_STOP = "is at to of on in by my me we it so as an or up no go he be do am us if le la du de au en et il un ce ne se sa ma ta je tu ou si ca ça sur".split()
MIDDLE_STOP = frozenset("est sont et ou le la les une ce ça pour avec dans sur qui que the a an by of on in is was to and or at for from that this it he she we they you i dollars euros percent people pages boxes bags copies jars sandwiches mistakes millimeters stamps o'clock am pm been no not so as my our their his her be has had goes more once before after until near behind under turns".split())
BAD_CONTEXT = frozenset("serial parcel série colis order commande ticket file dossier pièce request demande version tracker suivi item code article crates caisses".split())
AFTER_CONTEXT = frozenset("back tracker dos suivi closed close".split())

_DIGITS = "|".join(DIGIT_EN)
_NO_PAIR = rf"(?!(?:{'|'.join(PAIR_STOP)}) )"
_SPOKEN = re.compile(rf"\b(?:(?:[a-z] ){{2}}|{_NO_PAIR}[a-z]{{2}} )?(?:(?:{_DIGITS})[ ,.-]+){{5,}}(?:{_DIGITS})\b(?: [a-z]\b)?")
_FR = "|".join(sorted(NUMBER_FR, key=len, reverse=True))
_SPOKEN_FR = re.compile(rf"\bzéro(?:[ ,-]+(?:et[ -])?(?:{_FR})\b){{4,}}")
_SIX_DIGITS = re.compile(r"\d(?:[ .()-]*\d){5}")
_WRITTEN = {
    "intl": re.compile(r"(?:\+|\b00)\d{1,3}[ .-]?(?:\(0\)[ .-]?)?\d(?:[ .-]?\d){6,11}\b"),
    "trunk": re.compile(r"\b0\d(?:[ .-]?\d){7,9}\b"),
    "nanp": re.compile(r"(?:\b1[ .-])?(?:\(\d{3}\) ?|\b\d{3}[ .-])\d{3}[ .-]\d{4}\b"),
    "dashed": re.compile(r"\b\d{3}[ .-]\d{2}[ .-]\d{4}\b"),
    "iban": re.compile(_NO_PAIR + r"\b[a-z]{2} ?\d{2}(?: ?[\da-z]{4}){2,7}(?: ?[\da-z]{1,4})?\b(?:(?<= \d\d\d\d) \d{1,3}\b)?"),
    "letters": re.compile(_NO_PAIR + r"\b[a-z] ?[a-z] ?\d(?: ?\d){5,8}(?: ?[a-d]\b)?"),
    "insee": re.compile(r"\b[1-478][ .-]?\d{2}[ .-]?\d{2}[ .-]?\d[\dab][ .-]?\d{3}[ .-]?\d{3}(?:[ .-]?\d{2})?\b"),
    "plain": re.compile(r"\b\d{8,12}\b"),
    "grouped": re.compile(r"\b\d{4}(?: \d{4}){1,3}\b"),
}
INNER = frozenset(("intl", "trunk", "nanp", "dashed", "plain", "grouped"))
_EMAIL = re.compile(r"[\w.+-]+ ?(?:@|\(at\)|\[at\]) ?[\w-]+(?:(?:\.| ?(?:\[dot\]|\(dot\)) ?)[\w-]+)+")
_EMAIL_SAID = re.compile(r"(?:\w+ (?:dot|point|dash|tiret bas|tiret|underscore|plus) )*\w+ (?:at|arobase) \w+(?: (?:dash|tiret) \w+)*(?: (?:dot|point) \w+(?: (?:dash|tiret) \w+)*)+")
_NUM_EN = rf"(?:\d{{1,4}}(?: ?[a-d]\b)?|(?:(?:{'|'.join(NUMBER_EN)})\b(?:[ -]and)?[ -]){{1,6}})"
_STREET_EN = re.compile(rf"(?:\b(?:flat|apartment|unit|suite) (?:\d+|[a-z]+),? )?\b{_NUM_EN},? ?(?:[a-z][\w'-]* ){{1,3}}?(?:{'|'.join(STREET_EN)})\b\.?(?P<town>, [a-z][\w-]+)?")
_NUM_FR = rf"(?:\d{{1,4}}|(?:(?:{_FR})(?:[ -]et)?[ -])*(?:{_FR}))"
_STREET_FR = re.compile(rf"\b{_NUM_FR}(?: (?:bis|ter|quater|[a-d])\b)?,? (?:{'|'.join(STREET_FR)}) (?:du |des |de la |de l'|de |d')?[\w'-]+(?P<town>, \d{{5}} [\w-]+)?")
_DIGIT_SET = frozenset(DIGIT_EN)
_TOKEN = re.compile(r"\S+")
_STRIP = ".,;:!?…«»\"'()[]-"


class Text:
    """The matcher's view: lower case, one space, apostrophes alike, fillers and stutters left out."""

    __slots__ = ("text", "cores", "kept", "tokens", "bare", "starts", "lower", "words")

    def __init__(self, text: str):
        self.text = text.replace("’", "'")
        raw, low = self.text.split(), self.text.lower().split()
        self.cores = cores = [w.strip(_STRIP) for w in low]
        kept, last = [], ""
        for k, core in enumerate(cores):
            if core in FILLERS or (core == last and len(core) > 1 and core not in REPEATABLE and not core.isdigit()):
                continue
            kept.append(k)
            last = core
        self.kept = kept
        if len(kept) < len(raw):
            raw, low, cores = [raw[k] for k in kept], [low[k] for k in kept], [cores[k] for k in kept]
        self.tokens, self.bare = raw, cores
        self.starts = [0, *accumulate([len(w) + 1 for w in low])][: len(low)]
        self.lower = " ".join(low)
        self.words = set(cores)

    def origin(self, start: int, end: int) -> tuple[int, int]:
        """Characters of the original text behind matched characters; a stuttered last word goes along."""
        spans = [m.span() for m in _TOKEN.finditer(self.text)]
        a, b = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        first, last = spans[self.kept[a]], spans[self.kept[b]]
        left = first[0] + min(start - self.starts[a], first[1] - first[0])
        width = end - self.starts[b]
        right = last[0] + width
        if width >= len(self.tokens[b]):
            k = self.kept[b]
            stop = self.kept[b + 1] if b + 1 < len(self.kept) else len(self.cores)
            same = [j for j in range(k + 1, stop) if self.cores[j] == self.cores[k]]
            right = spans[same[-1]][1] if same else last[1]
        return left, max(left, right)

    def around(self, start: int, end: int) -> tuple[list[str], list[str]]:
        a, b = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        return self.bare[max(0, a - 4) : a], self.bare[b + 1 : b + 3]


REPEATABLE = frozenset(DIGIT_EN) | frozenset(NUMBER_FR) | frozenset(NUMBER_EN)


def said_digits(words: list[str]) -> int:
    n, factor = 0, 1
    for w in words:
        if w in ("double", "triple"):
            factor = 2 if w == "double" else 3
        elif w in DIGIT_EN:
            n, factor = n + factor, 1
    return n


def _context(before: list[str], after: list[str]) -> list[str]:
    out = ["bad"] if BAD_CONTEXT & set(before[-2:]) else []
    if AFTER_CONTEXT & set(after):
        out.append("bad after")
    out += [f"before {w}" for w in before[-2:] if not w.isdigit()]
    if before and before[-1].isdigit() or after and after[0].isdigit():
        out.append("within digits")
    return out


def proposals(view: Text, given: frozenset, family: frozenset) -> list[tuple]:
    """(start, end, kind, features, what the common words have to settle) in the matcher's characters."""
    s, out = view.lower, []
    if "@" in s or "at)" in s or "at]" in s:
        for m in _EMAIL.finditer(s):
            end = m.end()
            domain = re.sub(r" ?[\[(]dot[\])] ?", ".", re.split(r"@|[\[(]at[\])]", m.group())[-1]).replace(" ", "")
            known = domain in NO_CASE_DOMAINS
            out.append((m.start(), end, "email", ["written", "no case" if known else "open", "tld" if domain.rpartition(".")[2] in TLDS else "odd tld"], None))
    if (" at " in s or " arobase " in s) and (" dot " in s or " point " in s):
        for m in _EMAIL_SAID.finditer(s):
            parts = re.split(r" (?:at|arobase) ", m.group())
            domain = re.sub(r" (?:dot|point) ", ".", re.sub(r" (?:dash|tiret) ", "-", parts[-1]))
            words = domain.split(".")
            tld = next((k for k in range(len(words) - 1, 0, -1) if words[k] in TLDS), 0)
            known = ".".join(words[: tld + 1]) in NO_CASE_DOMAINS
            out.append((m.start(), m.end(), "email", ["said", "no case" if known else "open", "tld" if tld else "odd tld"], None))
    if _SIX_DIGITS.search(s):
        for shape, pattern in _WRITTEN.items():
            for m in pattern.finditer(s):
                hit, at = m.group(), m.start()
                if shape in INNER and hit[0] != "+" and at > 1 and s[at - 1] in " .-" and s[at - 2].isdigit():
                    continue  # a part of a longer number is no segment
                digits = sum(c.isdigit() for c in hit)
                before, after = view.around(m.start(), m.end())
                glued = m.end() < len(s) and s[m.end()] in "-@" or m.start() and s[m.start() - 1] in "-/@"
                base = [f"shape {shape}", f"{shape} {min(digits, 16)}", *_context(before, after), *["glued"] * bool(glued)]
                base.append("starts " + next(c for c in hit if c.isalnum()))
                for kind in ("phone", "id_number"):
                    out.append((m.start(), m.end(), kind, [f"{kind} {x}" for x in base], None))
    for m in _SPOKEN.finditer(s) if sum([w in _DIGIT_SET for w in view.bare]) > 5 else ():
        words = re.split(r"[ ,.-]+", m.group())
        n = said_digits(words)
        before, after = view.around(m.start(), m.end())
        first = next((w for w in words if w in DIGIT_EN), "")
        base = ["said", f"said {min(n, 12)}", *_context(before, after), "zero first" if first in ("zero", "oh", "o") else "other first", "letters" if len(words[0]) < 3 and words[0] not in DIGIT_EN else "no letters"]
        for kind in ("phone", "id_number"):
            out.append((m.start(), m.end(), kind, [f"{kind} {x}" for x in base], None))
    if "zéro" in view.words:
        for m in _SPOKEN_FR.finditer(s):
            before, after = view.around(m.start(), m.end())
            n = len(re.split(r"[ ,-]+", m.group()))
            out.append((m.start(), m.end(), "phone", ["phone said fr", f"phone fr {min(n, 12) // 3}", *[f"phone {x}" for x in _context(before, after)]], None))
    for pattern, types in ((_STREET_EN, STREET_EN), (_STREET_FR, STREET_FR)):
        if not view.words.isdisjoint(types):
            for m in pattern.finditer(s):
                end, town = m.end(), m.group("town")
                short = end - len(town or "")
                if town and town[2:] in MIDDLE_STOP:
                    end, town = short, None
                before, _ = view.around(m.start(), m.end())
                last = ("town", town[2:], short, _street(s[m.start() : short], types, before)) if town else None
                out.append((m.start(), end, "street_address", _street(s[m.start() : end], types, before), last))
    bare, tokens = view.bare, view.tokens
    for k, word in enumerate(bare):
        is_given = word in given
        titled = word in TITLES or (word == "me" and k + 1 < len(bare) and len(bare[k + 1]) == 1 and tokens[k + 1][-1] == ".") or tokens[k] == "M."
        if not is_given and not titled:
            continue
        if is_given and tokens[k][:1] not in "([" and k + 1 < len(bare):
            ends = tokens[k][-1] in ".?!:"
            out.append(_name(view, k, k + 1, k + 1, "given", ends, given, family, None))
        if is_given and k and tokens[k - 1][-1] not in ".?!:;":
            # the family name first; it counts where no title or given name takes it
            nxt = bare[k + 1] if k + 1 < len(bare) and tokens[k][-1] not in ".,?!" else ""
            out.append(_name(view, k - 1, k, k - 1, "reversed" + (" comma" if tokens[k - 1][-1] == "," else ""), False, given, family, nxt))
        if titled:
            j = k + 1
            while j < len(bare) and j <= k + 2 and (bare[j] in given or (len(bare[j]) == 1 and bare[j].isalpha())):
                j += 1
            if j < len(bare):
                middle = "title given" if j > k + 1 else "title"
                out.append(_name(view, k, j, j, middle, False, given, family, None))
    return [c for c in out if c[0] < c[1]]


def settle(proposed: list[tuple], common: frozenset) -> list[tuple[int, int, str, list[str]]]:
    """(start, end, kind, features): what depends on the common words is filled in."""
    out = []
    for a, b, kind, feats, left in proposed:
        if left is None:
            pass
        elif left[0] == "town":
            if left[1] in common:
                b, feats = left[2], left[3]
        else:
            _, shape, word, listed, capital, nxt = left
            known = word in common
            feats = [*feats, f"{shape} {'listed' if listed else 'common' if known else 'rare'}"]
            if known:
                feats.append(f"is {word}")
            if capital:
                feats.append("capital" if known else "capital rare")
            if nxt is not None:
                feats += ["then common", f"then {nxt}"] if nxt in common else ["then other", "then rare"]
        out.append((a, b, kind, feats))
    return out


def candidates(view: Text, given: frozenset, family: frozenset, common: frozenset) -> list[tuple[int, int, str, list[str]]]:
    return settle(proposals(view, given, family), common)


def _street(text: str, types: list[str], before: list[str]) -> list[str]:
    words = re.findall(r"(?<!\w)[^\W\d_]+(?:'[^\W\d_]+)?", text)
    fr = types is STREET_FR
    middle = [w for w in words if w not in types and w not in NUMBER_EN and w not in NUMBER_FR and w not in ("and", "flat")]
    stop = not fr and any(w in MIDDLE_STOP for w in middle)
    kind = next((w for w in words if w in types), "")
    return ["fr" if fr else "en", "digits" if text[0].isdigit() or "flat" in words else "said number",
            "function word" if stop else "name only", f"type {kind}", "no name" if not middle else "named",
            "place before" if before and before[-1] in ("at", "to", "au", "is", "est") else "other before"]


def _name(view: Text, a: int, b: int, f: int, shape: str, ends: bool, given: frozenset, family: frozenset, nxt: str | None) -> tuple:
    word = view.bare[f]
    start = view.starts[a] + (len(view.tokens[a]) - len(view.tokens[a].lstrip(_STRIP)))
    end = view.starts[b] + len(view.tokens[b].rstrip(_STRIP))
    alpha = word.replace("'", "").replace("-", "").isalpha()
    features = [shape, f"ending {word[-3:]}", f"ending {word[-2:]}",
                "given twice" if word in given else "once", "word" if alpha else "no word", "short" if len(word) < 4 else "long"]
    if ends:
        features.append("sentence between")
    return start, max(start, end), "person_name", features, ("name", shape, word, word in family, view.tokens[f][:1].isupper(), nxt)


Weights = dict[int, float]


@lru_cache(maxsize=1 << 17)
def key(kind: str, feature: str) -> int:
    """Number of a weight: one of its own, or one of ``OPEN`` for the features made of any word."""
    h = int.from_bytes(blake2b(f"{kind} {feature}".encode("utf-8", "replace"), digest_size=8).digest(), "little")
    return h % OPEN if " before " in feature or feature.startswith("ending ") else OPEN + h % (1 << 62)


def score(weights: Weights, kind: str, features: list[str]) -> float:
    return weights.get(key(kind, ""), 0.0) + sum([weights.get(key(kind, f), 0.0) for f in features])


def decode(segments: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str]]:
    """Best non-overlapping set: semi-Markov Viterbi in which plain text scores 0."""
    segments = sorted([x for x in segments if x[3] > 0], key=lambda x: (x[1], x[0]))
    if len(segments) < 2:
        return [x[:3] for x in segments]
    ends = [x[1] for x in segments]
    best, take = [0.0], []
    for k, (start, _, _, gain) in enumerate(segments):
        j = bisect_right(ends, start, 0, k)
        take.append((best[j] + gain > best[k], j))
        best.append(max(best[k], best[j] + gain))
    out, k = [], len(segments)
    while k:
        yes, j = take[k - 1]
        if yes:
            out.append(segments[k - 1][:3])
            k = j
        else:
            k -= 1
    return out[::-1]


def _lattice(segments: list[tuple]) -> tuple[list, object]:
    """Probability of each segment and the log of the total, by forward and backward sums; scores are numbers or arrays of many alike lattices."""
    points = sorted({p for a, b, _ in segments for p in (a, b)})
    at = {p: k for k, p in enumerate(points)}
    into: list[list[int]] = [[] for _ in points]
    outof: list[list[int]] = [[] for _ in points]
    for i, (a, b, _) in enumerate(segments):
        into[at[b]].append(i)
        outof[at[a]].append(i)
    forward: list = [0.0] * len(points)
    for k in range(len(points)):
        total = forward[k - 1] if k else 0.0
        for i in into[k]:
            total = np.logaddexp(total, forward[at[segments[i][0]]] + segments[i][2])
        forward[k] = total
    backward: list = [0.0] * len(points)
    for k in range(len(points) - 1, -1, -1):
        total = backward[k + 1] if k + 1 < len(points) else 0.0
        for i in outof[k]:
            total = np.logaddexp(total, backward[at[segments[i][1]]] + segments[i][2])
        backward[k] = total
    z = forward[-1]
    return [np.exp(np.minimum(0.0, forward[at[a]] + s + backward[at[b]] - z)) for a, b, s in segments], z


def _marginals(segments: list[tuple[int, int, float]]) -> list[float]:
    """Probability of each segment under the lattice."""
    return _lattice(segments)[0]


def _tally(parts: Counter, segments: list[tuple] | None) -> int:
    """Counts the runs of overlapping segments: (places in order, which are cases, numbers of the features)."""
    runs: list[list[tuple]] = []
    reach = 0
    for x in sorted(segments or (), key=lambda x: x[:2]):
        if runs and x[0] < reach:
            runs[-1].append(x)
            reach = max(reach, x[1])
        else:
            runs.append([x])
            reach = x[1]
    for run in runs:
        at = {p: k for k, p in enumerate(sorted({p for x in run for p in x[:2]}))}
        parts[tuple([(at[x[0]], at[x[1]]) for x in run]), tuple([x[4] for x in run]), tuple([tuple([key(x[2], f) for f in ("", *x[3])]) for x in run])] += 1
    return len(runs)


def _block(parts: Counter) -> tuple[np.ndarray, list[tuple]]:
    """The weights in use, and for each shape of run the counts, cases, numbers of features and features, as positions among these weights."""
    keys = sorted({f for _, _, runs in parts for feats in runs for f in feats})
    at = {f: k for k, f in enumerate(keys)}
    by: dict[tuple, list] = {}
    for (shape, gold, runs), n in parts.items():
        by.setdefault(shape, []).append((n, gold, runs))
    return np.array(keys, np.int64), [
        (shape, np.array([n for n, _, _ in own]), np.array([gold for _, gold, _ in own]), np.array([len(x) for _, _, runs in own for x in runs]),
         np.array([at[f] for _, _, runs in own for x in runs for f in x], np.int32)) for shape, own in by.items()]


def _slopes(weights: np.ndarray, block: list[tuple]) -> tuple[np.ndarray, int]:
    """Slope of the log likelihood by weight, and the log likelihood, in UNITs."""
    slope, value = np.zeros(len(weights), np.int64), 0
    for shape, counts, gold, lengths, flat in block:
        s = np.bincount(np.repeat(np.arange(len(lengths)), lengths), weights[flat], len(lengths)).reshape(gold.shape)
        probs, z = _lattice([(a, b, s[:, k]) for k, (a, b) in enumerate(shape)])
        off = np.rint((gold - np.stack(probs, 1)) * UNIT).astype(np.int64) * counts[:, None]
        slope += np.bincount(flat, np.repeat(off.ravel(), lengths), len(weights)).astype(np.int64)
        value += int((np.rint(((s * gold).sum(1) - z) * UNIT).astype(np.int64) * counts).sum())
    return slope, value


def _ascend(measure: Callable, at: np.ndarray) -> np.ndarray:
    """Where a concave value is greatest: limited-memory BFGS, steps halved until they rise."""
    past: deque = deque(maxlen=10)
    value, slope = measure(at)
    for _ in range(STEPS):
        if np.abs(slope).max() < 0.02:
            break
        way, back = slope.copy(), []
        for s, y in reversed(past):
            back.append(s @ way / (s @ y))
            way -= back[-1] * y
        way *= past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1 / np.linalg.norm(slope)
        for (s, y), a in zip(past, reversed(back)):
            way += s * (a - y @ way / (s @ y))
        size = 1.0
        while True:
            new_value, new_slope = measure(at + size * way)
            if new_value >= value + 1e-4 * size * (slope @ way):
                break
            size /= 2
            if size < 1e-6:
                return at
        s, y = size * way, slope - new_slope
        if s @ y > 0:
            past.append((s, y))
        at, value, slope = at + s, new_value, new_slope
    return at


def train(shown: Counter, keys: Iterable[int], slopes: Callable, share: float) -> Weights:
    """Weights of the greatest likelihood under a normal prior.

    ``shown`` are the runs of the generated sentences; ``keys`` are the weights that the texts use,
    ``slopes`` sums their slopes for (keys, weights), each text counting as ``share``.
    """
    first = np.array([key(kind, "") for kind in KINDS], np.int64)
    own, block = _block(shown)
    keys = np.union1d(np.union1d(own, first), np.array(sorted(keys), np.int64))
    at = np.searchsorted(keys, own)
    start = np.zeros(len(keys))
    start[np.searchsorted(keys, first)] = -1.0

    def measure(weights: np.ndarray) -> tuple[float, np.ndarray]:
        slope, value = slopes(keys, weights)
        more, also = _slopes(weights[at], block)
        slope = share * slope
        slope[at] += more
        off = weights - start
        return (share * value + also) / UNIT - DECAY / 2 * (off @ off), slope / UNIT - DECAY * off

    return dict(zip(keys.tolist(), _ascend(measure, start).tolist()))


def _label(found: list[tuple[int, int, str, list[str]]]) -> list[tuple[int, int, str, list[str], bool]] | None:
    """Distant labels: strict shapes and listed names are cases, known words are none, the unsure are left out."""
    out: list = []
    for a, b, kind, feats in found:
        f = set(feats)
        if kind == "person_name":
            if "given twice" in f or "no word" in f:
                gold = False
            elif any(x.endswith(" listed") for x in f):
                gold = True
            elif any(x.endswith(" common") for x in f):
                gold = False
            else:
                continue
        elif kind == "email":
            gold = "no case" not in f and "tld" in f
        elif kind == "street_address":
            gold = "name only" in f and "named" in f
        else:
            gold = _number_label(kind, f)
        out.append((a, b, kind, feats, gold))
    # of overlapping cases the longest is the labelled one
    for i, x in enumerate(out):
        if x[4] and any(y[4] and y is not x and y[0] < x[1] and x[0] < y[1] and (y[1] - y[0], -j) > (x[1] - x[0], -i) for j, y in enumerate(out)):
            out[i] = (*x[:4], False)
    return out or None


def _number_label(kind: str, f: set) -> bool:
    if f & {f"{kind} bad", f"{kind} bad after", f"{kind} glued", f"{kind} within digits"}:
        return False
    phone = f & {f"{kind} shape intl", f"{kind} shape trunk", f"{kind} shape nanp", "phone said fr"}
    said10 = f & {f"{kind} said 10", f"{kind} said 11"} and f"{kind} letters" not in f
    ident = f & {f"{kind} shape dashed", f"{kind} shape iban", f"{kind} shape letters", f"{kind} insee 13", f"{kind} insee 15"}
    said9 = f"{kind} said 9" in f or (f"{kind} said" in f and f"{kind} letters" in f)
    return bool(phone or said10) if kind == "phone" else bool((ident or said9) and not phone)


_CARRY = ("please note {} today", "it was sent to {} and then we went home", "the contact is {}", "so {} was on the form", "on a noté {} hier",
          "la personne à voir est {} demain", "envoyez cela à {} merci", "then we wrote down {} again", "use {} in the meantime", "voici {} pour la suite")
_PLAIN = ("the serial is {} on the back", "that is parcel {} in the tracker", "le numéro de série est {} au dos", "c'est le colis {} dans le suivi",
          "order {} is closed", "la commande {} est close", "file number {} please", "ticket {} is next", "la pièce {} a été changée")


def _sentences(given: list[str], family: list[str], n: int) -> list[tuple[str, str | None]]:
    """Generated (sentence, case text or None) pairs; deterministic."""
    rng = random.Random(5)
    digit = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    given, family = given or ["alex"], family or ["martin"]
    words = "zero one two three four five six seven eight nine".split()

    def said(k: int) -> str:
        """k digits in words, a few of them as "double"."""
        spoken = []
        while k:
            word = rng.choice([*words, "oh"])
            twice = k > 1 and rng.random() < 0.15
            spoken.append(f"double {word}" if twice else word)
            k -= 1 + twice
        return " ".join(spoken)

    streets = "mill oak station church silver birch old harbour copper green".split()
    rues = "lilas moulin tilleuls peupliers vieux-pont fontaine cordiers".split()
    out: list[tuple[str, str | None]] = []
    for k in range(n):
        g, f = rng.choice(given), rng.choice(family)
        kind = rng.randrange(10)
        if kind == 0:
            case = rng.choice([f"{g}.{f}@firm-{digit(2)}.test", f"{g}{digit(2)} at site dot example", f"{f} tiret bas {g} arobase poste point test", f"{g[0]}{f} [at] shop [dot] example"])
        elif kind == 1:
            case = rng.choice([f"+44 {digit(4)} {digit(6)}", f"0{digit(1)} {digit(2)} {digit(2)} {digit(2)} {digit(2)}", f"{rng.randint(2, 9)}{digit(2)}-555-{digit(4)}", f"+33 6 {digit(2)} {digit(2)} {digit(2)} {digit(2)}", f"0{digit(10)}", f"({rng.randint(2, 9)}{digit(2)}) 555-{digit(4)}", f"+44 (0){digit(4)} {digit(6)}"])
        elif kind == 2:
            case = said(rng.choice([10, 11]))
        elif kind == 3:
            case = rng.choice([f"{digit(3)}-{digit(2)}-{digit(4)}", f"ch{digit(2)} {digit(4)} {digit(4)} {digit(4)} {digit(4)} {digit(1)}", f"de{digit(20)}", f"qq{digit(6)}{rng.choice('abcd')}", f"zz{digit(7)}", f"{rng.choice('12')} {digit(2)} {digit(2)} {digit(2)} {digit(3)} {digit(3)} {digit(2)}", f"q q {digit(2)} {digit(2)} {digit(2)} {rng.choice('abcd')}", f"fr{digit(2)} {digit(4)} {digit(4)} {digit(4)} {digit(4)} {digit(4)} {digit(3)}", f"{rng.choice('12')}{digit(14)}"])
        elif kind == 4:
            case = said(9)
        elif kind == 5:
            case = rng.choice([f"{rng.randint(1, 240)}{rng.choice(['', 'a'])} {rng.choice(streets)} {rng.choice(STREET_EN[:11])}", f"{rng.choice(['twenty one', 'one hundred and six', 'eighty'])} {rng.choice(streets)} {rng.choice(STREET_EN[:11])}"])
        elif kind == 6:
            case = rng.choice([f"{rng.randint(1, 240)}{rng.choice(['', ' bis', ' ter', ' b'])}{rng.choice(['', ','])} {rng.choice(STREET_FR)} des {rng.choice(rues)}", f"{rng.choice(['quarante-deux', 'cent trois', 'dix'])} {rng.choice(STREET_FR)} {rng.choice(rues)}"])
        elif kind == 7:
            case = rng.choice([f"{g} {f}", f"{f} {g}", f"{f} {g}", f"{f}, {g}", f"Dr {g} {f}", f"madame {f}", f"Ms {f}", f"docteur {g} {f}", f"Mr {f}"])
        else:
            case = None
        if case is None:
            plain = rng.choice([digit(10), digit(5), f"0{digit(9)}", f"0{digit(3)} {digit(4)} {digit(4)}", f"{digit(4)} {digit(4)} {digit(4)}", digit(8)])
            site = rng.choice(NO_CASE_DOMAINS)
            mail = rng.choice([f"{rng.choice(streets)}@{site}", f"{rng.choice(streets)} at {site.replace('.', ' dot ')}", f"{g}.user@{site}"])
            out.append((rng.choice(_CARRY).format(mail) if rng.random() < 0.25 else rng.choice(_PLAIN).format(plain), None))
        else:
            out.append((rng.choice(_CARRY).format(case), case.lower()))
    return out


def _common(counts: dict[str, int], n: int, given: frozenset, family: frozenset) -> frozenset:
    """Words of at least 1/200 of the texts, so fewer than 200 times the words of a text; names are none."""
    least = max(3, n // 200)
    return frozenset(w for w, k in counts.items() if k >= least and w not in given and w not in family)


def _shown(given: frozenset, family: frozenset, common: frozenset) -> Counter:
    """Runs of the generated sentences."""
    parts: Counter = Counter()
    # half of the list is hidden from the generated sentences, so that unlisted names are learned too
    shown, rng = frozenset(sorted(family)[::2]), random.Random(2)
    for text, case in _sentences(sorted(given), sorted(family), GENERATED):
        view = Text(text)
        spot = view.lower.find(case) if case else -1
        inside = lambda x: case is not None and x[0] < spot + len(case) and spot < x[1]  # noqa: B023, E731
        found = candidates(view, given, family, common)
        # two patterns may propose the same span; the labelled one alone is the case, as a path holds one
        gold = {id(x[3]) for x in _label(found) or () if x[4] and inside(x)}
        # every other sentence is shown without its context words, so that shapes carry the weight
        bare = rng.random() < 0.5
        _tally(parts, [(a, b, kind, [f for f in feats if not bare or " before " not in f], id(x[3]) in gold)
                       for x, (a, b, kind, feats) in zip(found, candidates(view, given, shown, common))])
    return parts


def fit(texts: list[str], given: frozenset, family: frozenset) -> tuple[Weights, frozenset]:
    """Weights and common words of texts in memory; ``model_of`` has the same of a table."""
    views = [Text(t) for t in texts]
    common = _common(Counter(w for view in views for w in view.words), len(views), given, family)
    parts: Counter = Counter()
    for view in views:
        _tally(parts, _label(candidates(view, given, family, common)))
    own, block = _block(parts)

    def slopes(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, int]:
        slope, at = np.zeros(len(keys), np.int64), np.searchsorted(keys, own)
        slope[at], value = _slopes(weights[at], block)
        return slope, value

    return train(_shown(given, family, common), own.tolist(), slopes, min(1.0, BALANCE / max(1, len(views)))), common


def find(text: str | None, model: tuple) -> list[tuple[int, int, str]]:
    """Decoded (start, end, kind) in the characters of the text."""
    if not text:
        return []
    weights, common, given, family = model
    view = Text(text)
    segments = [(a, b, kind, score(weights, kind, feats)) for a, b, kind, feats in candidates(view, given, family, common)]
    return [(*view.origin(a, b), kind) for a, b, kind in decode(segments)]


def redact(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for a, b, kind in spans:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def _worker(model: tuple):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row_id, dirty, clean in zip(pdf["row_id"], pdf["dirty"], pdf["clean"]):
                d, c = find(dirty, model), find(clean, model)
                out.append((row_id, redact(dirty, d), redact(clean, c), sorted({k for *_, k in d}), sorted({k for *_, k in c})))
            yield pd.DataFrame(out, columns=["row_id", "dirty", "clean", "dirty_kinds", "clean_kinds"])

    return run


_READ = "row_id bigint, field string, proposed binary, word string, n bigint"
_TEXTS = " "  # no word; its count is that of the texts


def _reader(given: frozenset, family: frozenset):
    """Proposed segments of every text that has some, and in how many texts each word occurs."""
    columns = ["row_id", "field", "proposed", "word", "n"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            out = []
            for row_id, dirty, clean in zip(pdf["row_id"], pdf["dirty"], pdf["clean"]):
                for field, text in (("dirty", dirty), ("clean", clean)):
                    if text:
                        view = Text(text)
                        seen.update(view.words)
                        seen[_TEXTS] += 1
                        if proposed := proposals(view, given, family):
                            out.append((row_id, field, pickle.dumps(proposed), None, 0))
            yield pd.DataFrame(out, columns=columns)
            if len(seen) > 50_000:
                yield pd.DataFrame([(0, None, None, *x) for x in seen.items()], columns=columns)
                seen.clear()
        yield pd.DataFrame([(0, None, None, *x) for x in seen.items()], columns=columns)

    return run


def _blocks(common: frozenset):
    """Labelled runs of all texts, equal ones counted, in blocks."""

    def frame(parts: Counter) -> pd.DataFrame:
        keys, block = _block(parts)
        return pd.DataFrame({"keys": [keys], "block": [pickle.dumps(block)]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, n = Counter(), 0
        for pdf in batches:
            for proposed in pdf["proposed"]:
                n += _tally(parts, _label(settle(pickle.loads(proposed), common)))
                if len(parts) >= PARTS or n >= 50 * PARTS:
                    yield frame(parts)
                    parts, n = Counter(), 0
        if parts:
            yield frame(parts)

    return run


def _summer(keys: np.ndarray, weights: np.ndarray):
    """A partition's slopes by position among the weights, and its log likelihood at -1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slope, value = np.zeros(len(keys), np.int64), 0
        for pdf in batches:
            for own, block in zip(pdf["keys"], pdf["block"]):
                at = np.searchsorted(keys, own)
                more, also = _slopes(weights[at], pickle.loads(block))
                slope[at] += more
                value += also
        hit = np.flatnonzero(slope)
        yield pd.DataFrame({"at": np.append(hit, -1), "slope": np.append(slope[hit], value)})

    return run


def _finder(model: tuple):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, common, *_ = model
        for pdf in batches:
            out = []
            for row_id, field, proposed in zip(pdf["row_id"], pdf["field"], pdf["proposed"]):
                segments = [(a, b, kind, score(weights, kind, feats)) for a, b, kind, feats in settle(pickle.loads(proposed), common)]
                out += [(row_id, field, kind) for kind in {k for *_, k in decode(segments)}]
            yield pd.DataFrame(out, columns=["row_id", "field", "kind"])

    return run


def _lists(names: DataFrame) -> tuple[frozenset, frozenset]:
    """Given and family names; the list is a configuration table."""
    listed = names.select(F.lower(F.trim("entry")).alias("entry"), F.lower(F.trim("kind")).alias("kind")).distinct().collect()
    return tuple(frozenset(r["entry"].replace("’", "'") for r in listed if r["entry"] and r["kind"] == kind) for kind in ("given", "family"))


def _read(rows: DataFrame, given: frozenset, family: frozenset, row_id: str = "row_id") -> DataFrame:
    """Every text is read once; what is proposed in it is kept for training and decoding."""
    return checkpoint(spread(rows.select(F.col(row_id).alias("row_id"), "dirty", "clean")).mapInPandas(_reader(given, family), _READ))


def _model(read: DataFrame, given: frozenset, family: frozenset) -> tuple:
    """The model fitted to all texts; common words and slopes, as many as there are weights, reach the driver."""
    counts = read.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    n = counts.filter(F.col("word") == _TEXTS).agg(F.max("n")).first()[0] or 0
    often = counts.filter((F.col("n") >= max(3, n // 200)) & (F.col("word") != _TEXTS)).collect()
    common = _common({r["word"]: r["n"] for r in often}, n, given, family)
    blocks = checkpoint(read.filter("proposed is not null").select("proposed").mapInPandas(_blocks(common), "keys array<bigint>, block binary"))
    used = [r[0] for r in blocks.select(F.explode("keys")).distinct().collect()]

    def slopes(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, int]:
        slope, value = np.zeros(len(keys), np.int64), 0
        for at, x in blocks.mapInPandas(_summer(keys, weights), "at bigint, slope bigint").groupBy("at").agg(F.sum("slope")).collect():
            if at < 0:
                value = x
            else:
                slope[at] = x
        return slope, value

    return train(_shown(given, family, common), used, slopes, min(1.0, BALANCE / max(1, n))), common, given, family


def model_of(rows: DataFrame, names: DataFrame, row_id: str = "row_id") -> tuple:
    """(weights, common words, given names, family names) of all rows."""
    given, family = _lists(names)
    return _model(_read(rows, given, family, row_id), given, family)


def redacted(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Both fields with typed placeholders, and the kinds found in each."""
    ship(rows.sparkSession)
    model = model_of(rows, names)
    return spread(rows.select("row_id", "dirty", "clean")).mapInPandas(
        _worker(model), "row_id bigint, dirty string, clean string, dirty_kinds array<string>, clean_kinds array<string>")


def found(rows: DataFrame, names: DataFrame) -> DataFrame:
    """One row for each row, field and kind that occurs in it."""
    ship(rows.sparkSession)
    given, family = _lists(names)
    read = _read(rows, given, family)
    model = _model(read, given, family)
    return read.filter("proposed is not null").select("row_id", "field", "proposed").mapInPandas(_finder(model), "row_id bigint, field string, kind string").distinct()
