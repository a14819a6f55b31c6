"""Broken prompt and response pairs: a conditional random field tags response clauses.

Method: the response is cut into clauses; each gets features from its alignment with the
prompt (longest common subsequence over words, number words and fillers left out), the
share of its words that are function words of the prompt's language or of another, its
script, verbatim spans, how much of the prompt is still to come after it, and its words
and pairs of words that the prompt does not hold, hashed. A linear-chain conditional
random field tags every clause as answer, refusal, echo, foreign or unfinished; the
coverage of the tags, by words, makes the pair's defect. It is trained here on at most
``SAMPLE_ROWS`` sampled pairs: sound ones are left alone or given a defect, and responses
that have next to nothing of the prompt though they speak its language are shown as the
refusals they are. How refusals are worded is learned from these, not listed. Foreign
responses are those of the other language and clauses ciphered into languages that do not
exist, in several scripts, so that any language other than the prompt's is foreign.

Defined results: a response that is null or without letters and digits is ``empty`` when
the prompt has words other than fillers; a prompt without such words has no defect; a
repeated passage of the prompt counts once; whole texts of any length are read; an empty
table gives an empty result; a row has at most one defect.
"""

from __future__ import annotations

import random
import re
import unicodedata
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dictaspark.llm.sampling import hashed_sample
from dictaspark.session import ship, spread

TAGS = ("answer", "refusal", "echo", "foreign", "unfinished")
DEFECTS = ("empty", "truncated", "refusal", "copy", "other_language")
SAMPLE_ROWS = 1200
TO_COME = 1 / 3
EPOCHS = 12
HASHED = 1 << 12

FILLERS = frozenset("um uh er hmm euh bah ben hum".split())
NUMBERS = frozenset(
    "zero oh one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million double dollars dollar percent "
    "zéro un une deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt vingts trente quarante cinquante soixante cent cents mille euros euro pour "
    "dot point dash tiret underscore plus at arobase bas a p m am pm heures h".split())
FUNCTION_WORDS = {
    "en": "the of to and in is that it for was on are with as i be this have from not but they we you what can there an our your all their no so if my by has do will which who at when".split(),
    "fr": "le la les des du et est que qui dans pas pour sur avec ce il elle nous vous ne se au aux par plus sont mais ou où je tu on ça cette été même tout si comme leur donc notre mon à".split(),
    "de": "der die das und ist nicht ein eine ich wir sie zu den dem mit von auf für im es noch sich auch war wird nach bei aus am muss sein haben über hat nichts niemand".split(),
    "es": "el los las una y es que en del por con para no se lo su al como más pero sus le ya este sí porque esta entre cuando muy sin sobre también tiene nos hoy todo nada la de nadie".split(),
    "it": "il gli una che di è per con non sono si da come più ma anche questo della nel dei alla ho hanno essere fatto tutto".split(),
    "pt": "os as um uma que não com para por mais como mas foi ao ele das tem seu sua ou quando muito nos já está eu também só pelo".split(),
    "nl": "het een van en niet is dat op te zijn voor met die er aan ook als maar om bij nog uit wat dan we hij".split(),
}
_WORD = re.compile(r"[^\W_]+")
_CLAUSE = re.compile(r"[^.!?…\n]+[.!?…\n]*")
_LANG_OF = {}
for _name, _words in FUNCTION_WORDS.items():
    for _w in _words:
        _LANG_OF.setdefault(_w, []).append(_name)
_LANGS = tuple(FUNCTION_WORDS)


def votes(words: list[str]) -> dict[str, int]:
    out = dict.fromkeys(_LANGS, 0)
    for w in words:
        for name in _LANG_OF.get(w, ()):
            out[name] += 1
    return out


def prompt_words(text: str) -> list[str]:
    """Words without fillers, stutters, number words and passages already said."""
    out: list[str] = []
    last = ""
    for w in _WORD.findall(text.lower()):
        if w in FILLERS or w == last:
            continue
        last = w
        if w not in NUMBERS and not w[0].isdigit():
            out.append(w)
    seen: set = set()
    drop = bytearray(len(out))
    for k in range(len(out) - 3):
        run = (out[k], out[k + 1], out[k + 2], out[k + 3])
        if run in seen:
            drop[k : k + 4] = b"\1\1\1\1"
        else:
            seen.add(run)
    return [w for w, x in zip(out, drop) if not x] if any(drop) else out


def growth(prompt: list[str], response: list[str]) -> tuple[int, list[int]]:
    """Places of the prompt, as bits, where its common subsequence with the response grows; and lengths after each response word."""
    at: dict[str, int] = {}
    for k, w in enumerate(prompt):
        at[w] = at.get(w, 0) | (1 << k)
    full = (1 << len(prompt)) - 1
    v, lengths, n = full, [], 0
    for w in response:
        m = at.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
            n = len(prompt) - v.bit_count()
        lengths.append(n)
    return ~v & full, lengths


def to_come(grown: int, n: int) -> float:
    """Share of the prompt after the last place the response reaches; a stray last match does not count."""
    if not n:
        return 0.0
    places = []
    while grown and len(places) < 4:
        last = grown.bit_length() - 1
        places.append(last)
        grown ^= 1 << last
    k = 0
    while k + 1 < len(places) and k < 3 and places[k] - places[k + 1] > 5:
        k += 1
    return 1 - (places[k] + 1) / n if places else 1.0


FEATURES = 15
_SCRIPTS: dict[str, str] = {}


def script_of(letter: str) -> str:
    """Latin, Greek, Cyrillic, CJK and the like, by the letter's name."""
    if letter not in _SCRIPTS:
        _SCRIPTS[letter] = unicodedata.name(letter, "?").split(" ")[0].split("-")[0]
    return _SCRIPTS[letter]


def main_script(words: list[str]) -> str:
    """Script of most words, by their first letter."""
    count: dict[str, int] = {}
    for w in words:
        if not w[0].isdigit():
            name = "LATIN" if w[0].isascii() else script_of(w[0])
            count[name] = count.get(name, 0) + 1
    return max(sorted(count), key=lambda k: count[k]) if count else "LATIN"


def hashed(raw: list[str], known: set[str]) -> list[int]:
    """Buckets of the words, and pairs of words, that the prompt does not hold."""
    out, last = [], "^"
    for w in raw:
        if w not in known and not w[0].isdigit():
            out += [crc32(w.encode()) % HASHED, crc32(f"{last} {w}".encode()) % HASHED]
        last = w
    return out


#: Per clause: dense features, hashed features and words; and the pair's (to come, covered, verbatim).
Clauses = tuple[np.ndarray, list[list[int]], np.ndarray, np.ndarray]


def clauses_of(dirty: str, clean: str) -> Clauses | None:
    """Features of every clause of the response; None without words."""
    prompt = prompt_words(dirty)
    spans, response, counts, raws = [], [], [], []
    for m in _CLAUSE.finditer(clean):
        raw = _WORD.findall(m.group().lower())
        if raw:
            spans.append((m.start(), m.end()))
            words = [w for w in raw if w not in NUMBERS and w not in FILLERS and not w[0].isdigit()]
            raws.append(raw)
            response.extend(words)
            counts.append(len(words))
    if not spans:
        return None
    grown, lengths = growth(prompt, response)
    whole = dirty.strip()
    at = clean.find(whole) if whole else -1
    mine = votes(prompt)
    own = max(_LANGS, key=lambda k: mine[k])
    script, known = main_script(prompt), set(prompt)
    usual = mine[own] / max(1, len(prompt))  # prompts in languages without a list hold few of these words themselves
    rest = to_come(grown, len(prompt))
    out = np.zeros((len(spans), FEATURES))
    size = np.array([max(1, len(r)) for r in raws])
    start, done, total = 0, 0, max(1, len(response))
    covered = (lengths[-1] if lengths else 0) / max(1, min(total, len(prompt)))
    of_all = votes(response)
    foreign_pair = max((of_all[k] for k in _LANGS if k != own), default=0) > of_all[own]
    strange_pair = of_all[own] / total < 0.4 * usual or script != main_script(response)
    for k, ((a, b), n, raw) in enumerate(zip(spans, counts, raws)):
        after = lengths[start + n - 1] if start + n else 0
        match = (after - done) / n if n else 0.5
        start, done = start + n, max(done, after)
        v = votes(raw)
        other = max(v[x] for x in _LANGS if x != own)
        last = k == len(spans) - 1
        verbatim = at >= 0 and a < at + len(whole) and at < b
        closed = clean[b - 1 : b] in ".!?…\n"
        strange = v[own] / len(raw) < 0.4 * usual
        out[k] = (
            1.0, match, match < 0.34, v[own] / len(raw), strange and match < 0.34, (other - v[own]) / len(raw), other > v[own],
            foreign_pair and covered < 0.5, strange_pair and covered < 0.5, script != main_script(raw), verbatim, last and not closed, last * rest, last and rest >= TO_COME, covered)
    return out, [hashed(raw, known) for raw in raws], size, np.array([rest, covered, float(at >= 0)])


def emissions(x: np.ndarray, words: list[list[int]], w: np.ndarray) -> np.ndarray:
    """Scores of the tags for each clause; ``w`` holds the dense weights, then the hashed ones."""
    out = x @ w[:FEATURES]
    many = np.array([len(h) for h in words])
    if many.sum():
        flat = np.fromiter((c for h in words for c in h), np.int64)
        row = np.repeat(np.arange(len(words)), many)
        part = np.zeros_like(out)
        np.add.at(part, row, w[FEATURES + flat])
        out = out + part / np.sqrt(np.maximum(many, 1))[:, None]
    return out


def viterbi(emit: list[np.ndarray], trans: np.ndarray) -> list[np.ndarray]:
    """Best tags of each row, all rows of a batch step by step together."""
    if not emit:
        return []
    length = np.array([len(e) for e in emit])
    width = int(length.max())
    padded = np.zeros((len(emit), width, len(TAGS)))
    for k, e in enumerate(emit):
        padded[k, : len(e)] = e
    best = padded[:, 0].copy()
    back = np.zeros((len(emit), width, len(TAGS)), np.int8)
    for t in range(1, width):
        options = best[:, :, None] + trans[None]
        arg = options.argmax(1)
        new = options.max(1) + padded[:, t]
        live = (t < length)[:, None]
        best = np.where(live, new, best)
        back[:, t] = np.where(live, arg, np.arange(len(TAGS))[None])
    tag = best.argmax(1)
    out = np.zeros((len(emit), width), np.int64)
    for t in range(width - 1, -1, -1):
        out[:, t] = tag
        tag = back[np.arange(len(emit)), t, tag]
    return [out[k, : length[k]] for k in range(len(emit))]


Example = tuple[np.ndarray, list[list[int]], np.ndarray]


def train(examples: list[Example], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """(weights of dense and hashed features by tag, transitions) by gradient ascent on the conditional likelihood; deterministic."""
    w, trans = np.zeros((FEATURES + HASHED, len(TAGS))), np.zeros((len(TAGS), len(TAGS)))
    gw, gt = np.full_like(w, 1e-2), np.full_like(trans, 1e-2)
    order = list(range(len(examples)))
    rng = random.Random(3)

    def lse(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

    # all features of an example as one sparse row per clause
    sparse = []
    for x, words, _ in examples:
        at = np.array(sorted({c for h in words for c in h}), np.int64)
        place = {c: k for k, c in enumerate(at.tolist())}
        wide = np.zeros((len(x), FEATURES + len(at)))
        wide[:, :FEATURES] = x
        for k, h in enumerate(words):
            for c in h:
                wide[k, FEATURES + place[c]] += 1 / len(h) ** 0.5
        sparse.append((wide, np.concatenate([np.arange(FEATURES), FEATURES + at])))
    for _ in range(epochs):
        rng.shuffle(order)
        for k in order:
            (x, at), y = sparse[k], examples[k][2]
            e = x @ w[at]
            n = len(y)
            alpha, beta = np.zeros_like(e), np.zeros_like(e)
            alpha[0] = e[0]
            for t in range(1, n):
                alpha[t] = e[t] + lse(alpha[t - 1][:, None] + trans, 0)
            for t in range(n - 2, -1, -1):
                beta[t] = lse(trans + (e[t + 1] + beta[t + 1])[None], 1)
            z = lse(alpha[-1], 0)
            p = np.exp(alpha + beta - z)
            p[np.arange(n), y] -= 1
            dw = -(x.T @ p) - 1e-3 * w[at]
            dt = -1e-4 * trans
            for t in range(1, n):
                pair = np.exp(alpha[t - 1][:, None] + trans + (e[t] + beta[t])[None] - z)
                pair[y[t - 1], y[t]] -= 1
                dt = dt - pair
            gw[at] += dw * dw
            gt += dt * dt
            w[at] += 0.3 * dw / np.sqrt(gw[at])
            trans += 0.3 * dt / np.sqrt(gt)
    return w, trans


_REFUSED = {
    "en": ["I'm sorry, but I can't help with that request.", "Unfortunately I cannot process this content.", "As an assistant, I must decline to produce this text.", "I apologize, however this goes against my guidelines.",
           "I am not able to rewrite this recording, as it may contain private data.", "Could you rephrase your request?", "Sorry, it is not possible for me to answer.", "Please provide another recording."],
    "fr": ["Je suis désolé, mais je ne peux pas vous aider.", "Malheureusement je ne saurais traiter ce contenu.", "En tant qu'assistant, je dois refuser cette demande.", "Toutes mes excuses, il m'est impossible de réécrire ce texte.",
           "Je ne peux pas produire cette transcription, car elle contient des données privées.", "Pouvez-vous reformuler votre demande ?", "Désolé, je préfère ne pas répondre.", "Merci de fournir un autre enregistrement."],
}
#: First letter and number of letters of alphabets that ciphered words are written in; the last has no blanks.
_ALPHABETS = ((0x61, 26), (0x61, 26), (0x61, 26), (0x430, 32), (0x3B1, 24), (0x4E00, 400))


def ciphered(text: str, own: list[str], rng: random.Random) -> str:
    """The text in a language that does not exist: each word in made-up letters, the same word alike; numbers, and most names, stay."""
    first, many = rng.choice(_ALPHABETS)
    made: dict[str, str] = {}
    out = []
    for k, token in enumerate(text.split()):
        core = token.strip(".,;:!?…«»\"'()")
        low = core.lower()
        if not core or any(c.isdigit() for c in core) or k and core[0].isupper() and rng.random() < 0.7:
            out.append(token)
            continue
        if low not in made:
            made[low] = rng.choice(own) if rng.random() < 0.06 else "".join(chr(first + rng.randrange(many)) for _ in range(max(1, len(low) + rng.randrange(-1, 3))))
        out.append(token.replace(core, made[low]))
    return ("" if first == 0x4E00 else " ").join(out)


def planted(pairs: list[tuple[str, str]]) -> list[Example]:
    """Clause features and tags of sampled pairs: sound ones in turn left alone or given a defect, and refusals as they are."""
    rng = random.Random(7)
    by_lang: dict[str, list[str]] = {"en": [], "fr": []}
    good, out = [], []
    for dirty, clean in pairs:
        made = clauses_of(dirty, clean)
        prompt = prompt_words(dirty)
        lang = max(_LANGS, key=lambda k, v=votes(prompt): v[k])
        if made is None or lang not in by_lang or made[3][2]:
            continue
        said = _WORD.findall(clean.lower())
        fluent = votes(said)
        if made[3][1] < 0.3 and len(prompt) > 8 and fluent[lang] / len(said) > 0.25 and fluent[lang] >= max(fluent.values()):
            out.append((made[0], made[1], np.full(len(made[0]), 1)))
        elif made[3][1] >= 0.75 and made[3][0] <= 0.2:
            good.append((dirty, clean, lang))
            by_lang[lang].append(clean)
    for k, (dirty, clean, lang) in enumerate(good):
        kind, tag = k % 8, 0
        if kind == 1:
            clean, tag = " ".join(rng.sample(_REFUSED[lang], rng.randint(1, 3))), 1
        elif kind == 2:
            clean, tag = rng.choice(["", "Here it is:\n", "Voici : "]) + dirty, 2
        elif kind == 3:
            other = by_lang["fr" if lang == "en" else "en"]
            clean, tag = rng.choice(other) if other else ciphered(clean, FUNCTION_WORDS[lang], rng), 3
        elif kind == 4:
            clean, tag = ciphered(rng.choice(good)[1] if k % 16 == 4 else clean, FUNCTION_WORDS[lang], rng), 3
        elif kind in (5, 6):
            cut = rng.uniform(0.15, 0.6) if kind == 5 else rng.uniform(0.8, 0.95)
            clean, tag = clean[: max(12, int(len(clean) * cut))], 4 if kind == 5 else 0
        made = clauses_of(dirty, clean)
        if made is None:
            continue
        y = np.full(len(made[0]), tag)
        if tag == 4:
            y[:-1] = 0
        elif tag == 2:
            y = np.where(made[0][:, 10] > 0, 2, 0)
        out.append((made[0], made[1], y))
    return out


def judge(dirty: str | None, clean: str | None) -> str | None:
    """``empty`` or None, before any tagging."""
    if clean and _WORD.search(clean):
        return None
    return "empty" if any(w not in FILLERS for w in _WORD.findall((dirty or "").lower())) else ""


def defects(pairs: list[tuple[str | None, str | None]], model: tuple) -> list[tuple[str | None, list[float]]]:
    """(defect or None, share of response words by tag) for each pair."""
    w, trans = model
    out: list = [(None, [0.0] * len(TAGS))] * len(pairs)
    rows, dense, lists, sizes, facts, emits = [], [], [], [], [], []
    for k, (dirty, clean) in enumerate(pairs):
        early = judge(dirty, clean)
        if early is not None:
            out[k] = (early or None, [0.0] * len(TAGS))
            continue
        if not any(x not in FILLERS for x in _WORD.findall((dirty or "").lower())):
            continue
        x, words, size, fact = clauses_of(dirty, clean)
        rows.append(k)
        dense.append(x)
        lists += words
        sizes.append(size)
        facts.append(fact)
    if rows:
        emits = np.split(emissions(np.concatenate(dense), lists, w), np.cumsum([len(x) for x in dense])[:-1])
    for k, tags, size, fact in zip(rows, viterbi(emits, trans), sizes, facts):
        share = (np.bincount(tags, size, len(TAGS)) / size.sum()).tolist()
        defect = None
        if share[2] > 0 and fact[2]:
            defect = "copy"
        elif share[3] >= 0.5 and share[3] >= share[1]:
            defect = "other_language"
        elif share[1] >= 0.5:
            defect = "refusal"
        elif tags[-1] == 4 and fact[0] >= TO_COME:
            defect = "truncated"
        out[k] = (defect, share)
    return out


def _tagger(model: tuple):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at : at + 500]
                made = defects(list(zip(part["dirty"], part["clean"])), model)
                yield pd.DataFrame({"row_id": part["row_id"].to_numpy(), "defect": [d for d, _ in made], **{f"{t}_share": [s[k] for _, s in made] for k, t in enumerate(TAGS)}})

    return run


def tagged(rows: DataFrame, row_id: str = "row_id", prompt: str = "dirty", response: str = "clean") -> DataFrame:
    """Every pair with its defect, or null, and the share of each clause tag. At most SAMPLE_ROWS pairs reach the driver."""
    ship(rows.sparkSession)
    flat = rows.select(F.col(row_id).alias("row_id"), F.col(prompt).alias("dirty"), F.col(response).alias("clean"))
    # the first pairs by hash of their contents, whatever the partitions
    sample = hashed_sample(flat, ["row_id", "dirty", "clean"], SAMPLE_ROWS).filter("dirty is not null and clean is not null")
    pairs = [(r["dirty"], r["clean"]) for r in sample.select("dirty", "clean").collect()]
    model = train(planted(sorted(pairs)))
    shares = ", ".join(f"{t}_share double" for t in TAGS)
    return spread(flat).mapInPandas(_tagger(model), f"row_id bigint, defect string, {shares}")
