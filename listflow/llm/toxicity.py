"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of whole texts: densities of fixed lexicons and of one learnt from labelled documents, how close lexicon words stand to the second person,
capitals, punctuation, and obfuscation (digits for letters, split or stretched words). Margins of
trees that did not see a row calibrate the score.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listflow.llm import boosting
from listflow.llm.quality import MAX_LABELLED, labelled_sample, remainder, sampled_texts, score_texts, training_rows
from listflow.llm.textbytes import SPACE, Hasher, per_text, prefix_ends, text_of, word_hashes, words

# Lower-case words by kind, in English, Spanish, French and German.
LEXICONS = {
    "insult": (
        "idiot idiots moron morons imbecile imbeciles fool fools dumbass jackass jerk jerks loser losers clown clowns "
        "scum scumbag trash vermin parasite parasites pig pigs rat rats dog swine creep creeps freak freaks lunatic "
        "psycho coward cowards liar liars bastard bastards twat twit wanker prick douche douchebag halfwit nitwit "
        "dimwit dunce retard simpleton bigot idiota idiotas imbecil imbeciles estupido payaso basura escoria cretino "
        "idiote idiots imbécile crétin abruti connard connasse ordure clochard bouffon trottel dummkopf vollidiot "
        "depp arschloch mistkerl abschaum versager schwachkopf hund schwein"),
    "demeaning": (
        "stupid dumb pathetic worthless useless disgusting disgraceful ugly filthy nasty vile repulsive revolting "
        "despicable contemptible ridiculous laughable brainless clueless ignorant incompetent inferior gross "
        "sickening hateful pitiful miserable mindless spineless hideous rotten estúpido inútil asqueroso patético "
        "repugnante stupide inutile pathétique dégoûtant minable nul dumm wertlos nutzlos erbärmlich widerlich "
        "ekelhaft hässlich"),
    "profanity": (
        "fuck fucks fucked fucker fuckers fucking motherfucker shit shits shitty bullshit crap damn goddamn ass arse "
        "asshole assholes bitch bitches piss pissed dick cock cunt slut whore bollocks bugger mierda puta puto "
        "joder cabron pendejo coño merde putain salope enculé foutre scheisse scheiße verdammt hure fick ficken"),
    "threat": (
        "kill killed murder dead hurt destroy strangle stab shoot beat punch burn hunt smash crush "
        "suffer regret matar morir tuer mourir crève töten sterben umbringen"),
    "hostility": (
        "hate hates hated despise loathe shut suck sucks screw stfu gtfo kys odio odias déteste hais hasse verachte "
        "verpiss"),
}
SECOND_PERSON = (
    "you your yours yourself yourselves u ur youre ya tu tú te ti contigo usted ustedes vosotros tus toi ton ta tes "
    "vous votre vos du dich dir dein deine deinen deiner ihr euch euer eure")
#: Digits and signs that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "+": "t"}
#: Code points of the stems that are learnt beside whole words, for languages that inflect.
STEMS = (4, 5, 6, 7)
#: Words and stems of the learnt lexicon at most, toxic documents that must hold one, the evidence (G squared)
#: that it goes with toxic documents, and by how much it is more frequent there.
LEAST_HOLDERS, LEAST_EVIDENCE, LEAST_RATIO = 3, 15.0, 30.0
#: Words between a lexicon word and the second person that count as close.
NEAR = 5

FEATURES = (
    [f"{kind}_{what}" for kind in (*LEXICONS, "learnt") for what in ("density", "count", "hidden")]
    + ["any_density", "any_count", "kinds", "near_count", "near_share", "second_person", "log_words", "capitals",
       "shouted_words", "loud", "loud_runs", "asking", "starred_words", "lookalike_words", "stretched_words", "symbols"])


def _table(folded: bool) -> np.ndarray:
    """What each byte becomes: letters in lower case, digits and bytes beyond ASCII as they are, else a blank."""
    out = np.full(256, 32, np.uint8)
    for c in range(256):
        if chr(c).isascii() and chr(c).isalnum():
            out[c] = ord(chr(c).lower())
        elif c >= 128:
            out[c] = c
    if folded:
        for sign, letter in LOOKALIKES.items():
            out[ord(sign)] = ord(letter)
    return out


_PLAIN, _FOLDED = _table(False), _table(True)
#: The same blanks as in ``_PLAIN``, for regular expressions.
_BLANKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_JOINTS = np.zeros(256, bool)
_JOINTS[list(b".-_*'~")] = True


def _lowered(data: np.ndarray) -> np.ndarray:
    """Words and blanks by ``_PLAIN``, with accented Latin capitals in lower case too."""
    out = _PLAIN[data]
    accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[accented] += 0x20
    return out


def _kept_bytes(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    moved = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], moved[offsets]


def _fold(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts without the signs that split words, with letters for lookalikes, and doubled letters single.

    A sign between two non-blanks goes; one at a word's border is a blank, and so is a lookalike sign there.
    """
    inner = np.zeros(len(data), bool)
    inner[1:-1] = ~SPACE[data[:-2]] & ~SPACE[data[2:]]
    letter = _PLAIN[data] != 32
    beside = np.zeros(len(data), bool)
    beside[1:-1] = letter[2:]
    out = np.where(letter, _FOLDED[_lowered(data)], np.where(inner & beside, _FOLDED[data], np.uint8(32)))
    out, offsets = _kept_bytes(out, offsets, ~(inner & _JOINTS[data]))
    again = np.zeros(len(out), bool)
    again[1:] = (out[1:] == out[:-1]) & (out[1:] >= 97) & (out[1:] <= 122)
    again[offsets[:-1][offsets[:-1] < len(out)]] = False
    return _kept_bytes(out, offsets, ~again)


def _hashed(lines: list[str], fold: bool) -> np.ndarray:
    raw = [w.encode() for w in lines]
    if not raw:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in raw])])
    if fold:
        data, offsets = _fold(data, offsets)
    return np.unique(word_hashes(data, offsets[:-1], offsets[1:]))


_WORDS = {kind: _hashed(text.split(), False) for kind, text in LEXICONS.items()}
_HIDDEN = {kind: _hashed(text.split(), True) for kind, text in LEXICONS.items()}
_YOU = _hashed(SECOND_PERSON.split(), False)


def _known(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(hashes), bool)
    at = np.searchsorted(table, hashes)
    return table[np.minimum(at, len(table) - 1)] == hashes


def _running(mask: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(mask)])


@dataclass
class Learnt:
    """Words and stems (with a ``*``) learnt from labels."""

    terms: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        whole = [t for t in self.terms if t[-1] != "*"]
        self.plain, self.folded = _hashed(whole, False), _hashed(whole, True)
        self.stems = {k: _hashed([t[:-1] for t in self.terms if t[-1] == "*" and len(t) == k + 1], False) for k in STEMS}

    def known(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, hasher: Hasher) -> np.ndarray:
        """Whether each word is a learnt one or has a learnt stem."""
        hit = _known(hashes, self.plain)
        for length, table in self.stems.items():
            if len(table):
                hit |= _known(hasher.spans(starts, prefix_ends(data, starts, ends, length)), table)
        return hit


def toxic_features(learnt: Learnt, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``FEATURES`` of each text, one row per text; an empty text has zeros."""
    n = len(offsets) - 1
    plain = _lowered(data)
    starts, ends, at = words(plain, offsets)
    hasher = Hasher(plain)
    hashes, text = hasher.spans(starts, ends), text_of(starts, offsets)
    count = np.diff(at)
    per = np.maximum(count, 1)
    folded, folded_offsets = _fold(data, offsets)
    f_starts, f_ends, f_at = words(folded, folded_offsets)
    f_hashes = word_hashes(folded, f_starts, f_ends)
    columns, hit, kinds = [], np.zeros(len(starts), bool), np.zeros(n)
    lists = [(_known(hashes, table), _HIDDEN[kind]) for kind, table in _WORDS.items()]
    lists.append((learnt.known(plain, starts, ends, hashes, hasher), learnt.folded))
    for own, hidden in lists:
        # "hidden" counts what only shows after folding
        masked = per_text(_known(f_hashes, hidden), f_at)
        plainly = per_text(own, at)
        columns += [plainly / per, np.log1p(plainly), np.log1p(np.maximum(masked - plainly, 0))]
        hit |= own
        kinds += plainly > 0
    total = per_text(hit, at)
    you = np.flatnonzero(_known(hashes, _YOU))
    place, gap = np.flatnonzero(hit), np.full(int(hit.sum()), 10**9)
    if len(you):
        for side in (np.searchsorted(you, place) - 1, np.searchsorted(you, place)):
            near = you[np.clip(side, 0, len(you) - 1)]
            gap = np.minimum(gap, np.where(text[near] == text[place], np.abs(near - place), 10**9))
    close = np.bincount(text[place][gap <= NEAR], minlength=n)[:n]
    raw_starts, raw_ends, raw_at = words(data, offsets)
    raw_per = np.maximum(np.diff(raw_at), 1)
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    u, lo = _running(upper), _running(lower)
    star = _running(np.isin(data, np.frombuffer(b"*#@$%", np.uint8)))
    digit = _running((data >= 48) & (data <= 57))
    letters = (u + lo)[raw_ends] - (u + lo)[raw_starts]
    shouted = (letters >= 2) & (lo[raw_ends] == lo[raw_starts])
    inner_star = (letters >= 2) & (star[np.maximum(raw_ends - 1, raw_starts)] - star[np.minimum(raw_starts + 1, raw_ends)] > 0)
    lookalike = (letters >= 2) & (digit[raw_ends] - digit[raw_starts] > 0)
    triple = np.zeros(len(data), bool)
    triple[2:] = (plain[2:] == plain[1:-1]) & (plain[2:] == plain[:-2]) & (plain[2:] >= 97) & (plain[2:] <= 122)
    t = _running(triple)
    stretched = t[raw_ends] - t[np.minimum(raw_starts + 2, raw_ends)] > 0
    loud = data == 33
    runs = np.zeros(len(data), bool)
    runs[1:] = loud[1:] & loud[:-1]
    size = np.maximum(np.diff(offsets), 1)

    def share(mask: np.ndarray) -> np.ndarray:
        sums = _running(mask)
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / size

    signs = np.isin(data, np.frombuffer(b"#*$%&<>|@^~", np.uint8))
    columns += [
        total / per, np.log1p(total), kinds, np.log1p(close), close / np.maximum(total, 1),
        per_text(_known(hashes, _YOU), at) / per, np.log1p(count),
        share(upper) / np.maximum(share(upper) + share(lower), 1e-9),
        per_text(shouted, raw_at) / raw_per, share(loud), share(runs), share(data == 63),
        per_text(inner_star, raw_at) / raw_per, per_text(lookalike, raw_at) / raw_per,
        per_text(stretched, raw_at) / raw_per, share(signs)]
    return np.stack(columns, axis=1).astype(np.float32)


@dataclass
class ToxicityModel:
    """The learnt lexicon, trees, and the knots that turn their margin into a calibrated probability."""

    learnt: Learnt
    forest: boosting.Forest
    margins: np.ndarray
    rates: np.ndarray

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Calibrated probability per text; equal margins score alike and order is kept."""
        x = toxic_features(self.learnt, data, offsets)
        return np.interp(self.forest.margins(x), self.margins, self.rates)


def calibrated(x: np.ndarray, y: np.ndarray, folds: int = 5, **trees) -> tuple[boosting.Forest, np.ndarray, np.ndarray]:
    """Trees on all rows, and isotonic knots from the margin that each row gets without its fold.

    Rows are dealt to folds in turn within each label, so every fold has both where it can.
    """
    forest = boosting.fit(x, y, **trees)
    if len(y) < 2 * folds or y.min() == y.max():
        rate = float((y.sum() + 1) / (len(y) + 2)) if len(y) else 0.5
        return forest, np.array([0.0]), np.array([rate])
    fold = np.zeros(len(y), np.int64)
    for label in (0, 1):
        own = np.flatnonzero(y == label)
        fold[own] = np.arange(len(own)) % folds
    unseen = np.zeros(len(y))
    for k in range(folds):
        unseen[fold == k] = boosting.fit(x[fold != k], y[fold != k], **trees).margins(x[fold == k])
    return forest, *boosting.isotonic(unseen, y)


def learn_lexicon(sampled: DataFrame) -> Learnt:
    """Words that go with toxic documents, from (_text, _label); all whose evidence suffices in the bounded sample."""
    totals = sampled.agg(F.count_if(F.col("_label") == 1).alias("bad"), F.count_if(F.col("_label") == 0).alias("good")).first()
    if not totals.bad or not totals.good:
        return Learnt()
    # a document counts once for each of its words
    own = F.array_distinct(F.split(F.regexp_replace(F.lower("_text"), _BLANKS, " "), " "))

    def stems_of(length: int):
        return F.transform(F.filter(own, lambda w: F.length(w) >= length),
                           lambda w: F.concat(F.substring(w, 1, length), F.lit("*")))

    term = F.explode(F.array_distinct(F.concat(own, *[stems_of(k) for k in STEMS])))
    found = (sampled.select("_label", term.alias("term")).filter("length(term) > 1")
             .groupBy("term").agg(F.sum("_label").alias("bad"), F.sum(1 - F.col("_label")).alias("good")))
    bad, good, rate = F.col("bad"), F.col("good"), totals.bad / (totals.bad + totals.good)
    expected = [(bad, (bad + good) * rate), (good, (bad + good) * (1 - rate))]
    evidence = 2 * sum(F.when(n > 0, n * F.log(n / e)).otherwise(0.0) for n, e in expected)
    often = bad / totals.bad > LEAST_RATIO * good / totals.good
    chosen = (found.filter((bad >= LEAST_HOLDERS) & often).withColumn("evidence", evidence)
              .filter(F.col("evidence") >= LEAST_EVIDENCE))
    return Learnt(sorted(r.term for r in chosen.collect()))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", by: int = 3, held: int = 1,
                 key: str = "doc_id", text: str = "text", most: int = MAX_LABELLED) -> ToxicityModel:
    """A model for ``label`` from labelled rows whose id's remainder modulo ``by`` is not ``held``.

    The sample's texts are written once. Half of them are described with the lexicon learnt from the
    other half, so that the trees don't trust words that a document itself brought in; the final
    lexicon is learnt from all.
    """
    sample = labelled_sample(labels, label, remainder(F.col(key), by) != held, key, most)
    sampled = sampled_texts(docs, sample, key, text)
    half = F.ascii(F.md5(F.concat(F.lit("half:"), F.col("_key").cast("string")))) % 2
    lexicons = [learn_lexicon(sampled.filter(half == k)) for k in (0, 1)]
    parts = [training_rows(sampled.filter(half == k), partial(toxic_features, lexicons[1 - k])) for k in (0, 1)]
    x, y = np.concatenate([p[1] for p in parts if len(p[2])] or [np.zeros((0, len(FEATURES)), np.float32)]), np.concatenate([p[2] for p in parts])
    return ToxicityModel(learn_lexicon(sampled), *calibrated(x, y))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the calibrated probability of toxicity in ``into``; null and empty texts score as empty."""
    return score_texts(docs, model.scores, text, into)
