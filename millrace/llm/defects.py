"""Broken prompt and response pairs.

A linear classifier with one head for each defect over hashed word n-grams of the response and features of the pair (what is left of
the response without labels, how far prompt and response cover each other, which languages they are in, how the
response ends). It is trained on responses made defective on purpose from a bounded sample of pairs: cut, copied, swapped for one in another
language, refused, emptied; and on sound ones that look alike. Each head's threshold is calibrated on pairs held out.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keep
from . import cuts
from .arrays import U, mixed
from .endings import NOTHING
from .residue_rules import QUOTED
from .words import words_of

DEFECTS = ("empty", "truncated", "refusal", "copied", "wrong_language")
#: Pairs of the sample that training pairs are made of, taken by the hash of their ids.
SAMPLE = 1500
HASHED = 1024
#: One training pair in so many is held out for calibration.
HELD = 4

# Frequent words that tell the languages apart.
STOPWORDS = {
    "en": "the of and to is was were that it with for on at when in by be are after which how why if than from without before an this not or as you i can my",
    "de": "der die das und ist nicht ein eine einen den dem des mit von zu im auf für wurde wurden wie warum wenn bei ohne vor danach zuerst aus als ich kann",
    "fr": "le et est qui une un du pour dans pas sur au avec sans ont été ne comme quand après dès d l les que je vous à ce cette par son",
    "es": "el los y una del por para con sin fueron cuando como según luego primero aunque antes al sigue las que es no se lo un yo puedo en está",
}
# Names of the languages, in each of them.
LANGUAGE_NAMES = {
    "en": r"\benglish\b|englisch|anglais|inglés",
    "de": r"\bgerman\b|deutsch|allemand|alemán",
    "fr": r"\bfrench\b|französisch|français|francés",
    "es": r"\bspanish\b|spanisch|espagnol|español|castellano",
}
REPEAT = re.compile(r"\brepeat|word for word|verbatim|\bcopy (?:the|this)|wiederhol\w* .{0,60}(?:satz|sätze|wort)|wörtlich|wort für wort|répét|répèt|mot pour mot|mot à mot|repit|repet|palabra por palabra|literalmente", re.I)
THOUGHT = re.compile(r"<(think|thinking|thought|reasoning|analysis)>.*?(?:</\1>|\Z)", re.S | re.I)
TAG = re.compile(r"</?[a-z_]+/?>", re.I)
WORD = re.compile(r"[^\W_]+")

#: Parts that refusals for training are composed of, by language: openings, refusals, reasons, closings; written from general knowledge.
REFUSALS = {
    "en": (
        ["", "", "I'm sorry,", "Sorry, but", "I apologize, but", "I’m really sorry, however", "Regrettably,", "As an AI assistant,", "Thank you for reaching out, but", "I understand why you ask, but", "To be honest,"],
        "I can't assist with that|I’m not able to help with this|I cannot fulfill this request|I won't provide that|I can’t give you this information|I am unable to answer that question|I have to decline|I decline to answer|I respectfully decline|I'm going to pass on this one|I don't feel comfortable answering|that isn't something I can do|it would not be right for me to respond|I must refuse to do this|I refuse|I am not permitted to discuss this|helping with that is not possible for me|this is outside of what I may do|I will not be writing about this|I would prefer not to answer|I'd rather stay away from this subject|I cannot comply with your request|you should look for help somewhere else".split("|"),
        ["", "", " as it could be dangerous", " because of my content policy", " because it may be unsafe", " since this topic is restricted", " for ethical reasons", ", and I ask for your understanding"],
        ["", "", " Please consult a professional.", " Is there anything else I can do for you?", " Let me know if you have a different question.", " I'd be happy to help with another topic."],
    ),
    "de": (
        ["", "", "Es tut mir sehr leid,", "Ich bitte um Nachsicht, doch", "Ich bedaure,", "Leider", "Als KI-Assistent", "Vielen Dank für die Anfrage, aber", "Ehrlich gesagt:"],
        "kann ich Ihnen hierbei nicht helfen|ich kann diese Anfrage nicht erfüllen|dazu kann ich keine Auskunft geben|das darf ich nicht beantworten|ich lehne diese Anfrage ab|ich werde das nicht schreiben|ich möchte dazu nichts sagen|das ist mir nicht erlaubt|hierauf gebe ich keine Antwort|ich muss das leider ablehnen|solche Texte liefere ich nicht|damit kann ich nicht dienen".split("|"),
        ["", "", ", da es gefährlich sein könnte", " wegen meiner Richtlinien", " aus ethischen Gründen", ", weil dieses Thema gesperrt ist"],
        ["", "", " Bitte wenden Sie sich an eine Fachperson.", " Kann ich sonst noch etwas für Sie tun?", " Fragen Sie mich gern etwas anderes."],
    ),
    "fr": (
        ["", "", "Je suis navré,", "Désolée, mais", "Je regrette,", "Hélas,", "En tant qu'assistant,", "Je vous remercie de votre message, mais", "Pour être honnête,"],
        "je ne peux pas répondre à cette demande|je ne suis pas autorisé à en parler|je refuse de traiter ce sujet|je ne vais pas écrire cela|il ne m'est pas permis de répondre|je dois refuser|je ne peux pas vous fournir cette information|je préfère ne rien dire là-dessus|je ne peux rien faire pour vous ici|cela dépasse ce que je peux faire|je décline votre demande|je ne traite pas ce genre de contenu".split("|"),
        ["", "", " parce que cela pourrait être dangereux", " en raison de mes règles", " pour des raisons éthiques", ", car ce sujet est interdit"],
        ["", "", " Veuillez consulter un professionnel.", " Puis-je vous aider autrement ?", " Essayez avec une autre question."],
    ),
    "es": (
        ["", "", "Lo lamento,", "Perdona, pero", "Lo siento mucho,", "Por desgracia,", "Como asistente,", "Te agradezco el mensaje, pero", "Para ser sincero,"],
        "no puedo responder a esta solicitud|no me está permitido hablar de eso|me niego a tratar este tema|no escribiré sobre esto|tengo que negarme|no puedo darte esa información|prefiero no decir nada al respecto|no puedo hacer nada por ti aquí|eso queda fuera de lo que puedo hacer|rechazo tu solicitud|no trabajo con ese tipo de contenido|no estoy autorizado a contestar".split("|"),
        ["", "", " porque podría ser peligroso", " debido a mis reglas", " por razones éticas", ", ya que este tema está restringido"],
        ["", "", " Consulta a un profesional.", " ¿Puedo ayudarte con otra cosa?", " Prueba con una pregunta distinta."],
    ),
}
#: Sound openings with words of a refusal or an apology, for training; written from general knowledge.
HARMLESS = (
    "Sorry about the mix-up earlier.|Sorry it took so long to write back.|Apologies for the typo above.|I'm sorry your first try failed; here is a better one.|You cannot skip the second step, though the third is optional.|I can't recommend this approach enough.|I can't find an error in what you wrote, so only the style is left.|"
    "I'm not able to say which is best, so I compare them all.|Unfortunately the short way does not work, so we go the long one.|I won't go into every detail, but the main idea is this.|The guard answered: \"I refuse to open the gate.\" Here is what that tells us.|This might break the rules of some clubs, so check them first.|"
    "Ich bitte um Entschuldigung für den Tippfehler.|Leider gibt es keinen kürzeren Weg, also der Reihe nach.|Tut mir leid, dass es so lange gedauert hat.|Pardon pour la faute de frappe.|Hélas, il n'y a pas de raccourci, donc pas à pas.|Siento la demora en contestar.|Por desgracia no hay atajo, así que vamos paso a paso.|Disculpa la errata de antes.".split("|")
)
BLANKS = ["", " ", "\n\n", "\t \n", "​", "N/A", "null", "[]", '""', "{}", "-", "...", "```\n```", "[no content]", "<answer></answer>", "Answer:", "Response: ", "None", "<think>I weigh the options.</think>", "<think>Erst prüfen.</think>\n\n"]
SHORT = ["Yes", "No.", "None of them", "0", "42", "Both", "Ja", "Nein", "Oui", "Non", "Sí", "Only the first", "17 of them", "Rosalind"]

#: Kinds of words, and of pairs of neighbouring words, that refusals are made of, in four languages: a speaker, what the speaker doesn't
#: do, excuses, reasons, ways out. An apostrophe parts words.
MANNERS = (
    "i me my ich mir mich meine meinen meinem meiner je j m moi mes yo mí mis puedo debo prefiero quiero voy estoy tengo",
    "can_t cannot unable not_able impossible won_t can_not could_not will_not would_not must_not may_not do_not don_t am_not is_not isn_t rather_not prefer_not decline declined refuse refused reject pass_on ablehnen lehne verweigere verweigern nicht keine "
    "ne_peux ne_puis ne_vais ne_suis ne_veux ne_souhaite refuse refuser décline décliner préfère_ne préfère_pas pas_autorisé en_mesure m_est no_puedo no_debo no_voy no_quiero no_me no_estoy no_es rechazo rechazar negarme niego prefiero_no",
    "sorry apologize apologies apologise unfortunately regret regrettably language_model as_an assistant appreciate thank thanks leid leider entschuldigung entschuldigen bedaure bedauere sprachmodell danke désolé désolée navré navrée malheureusement regrette modèle_de merci siento lamento lamentablemente perdón perdona disculpa desgracia modelo_de asistente gracias",
    "guidelines guideline policy policies safe safety unsafe harm harmful danger dangerous ethics ethical allowed permitted richtlinien vorgaben sicherheit gefährlich ethischen erlaubt règles sécurité dangereux éthiques autorisé autorisée normas reglas seguridad peligroso éticas permitido",
    "something_else somewhere_else anything_else elsewhere another_question another_topic different_question different_topic other_question other_topic another_subject professional qualified understanding andere_frage anderes_thema verständnis fachperson autre_question autre_sujet autre_chose compréhension professionnel otra_pregunta otra_cosa otro_tema comprensión profesional",
)


@cache
def manners() -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, kinds), sorted by hash, of the single words and of the pairs."""
    out = []
    for n in (1, 2):
        told = [(w.split("_"), k) for k, every in enumerate(MANNERS) for w in every.split() if w.count("_") == n - 1]
        h = words_of([" ".join(w) for w, _ in told])[0].reshape(-1, n)
        h = h[:, 0] if n == 1 else mixed(h[:, 0] * U(0x100000001B3) + h[:, 1])
        order = np.argsort(h)
        out.append((h[order], np.array([k for _, k in told])[order]))
    return out


def manners_of(rows: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """How many words and pairs (row, hash) of each kind every row has; a word of two kinds counts in one."""
    out = np.zeros(n * len(MANNERS))
    for (row, words), (known, kind) in zip(rows, manners()):
        at = np.minimum(np.searchsorted(known, words), len(known) - 1)
        hit = known[at] == words
        out += np.bincount(row[hit] * len(MANNERS) + kind[at[hit]], minlength=len(out))
    return out.reshape(n, len(MANNERS))


_STOP = {x: set(w.split()) for x, w in STOPWORDS.items()}
_ONLY = {w: x for x, own in _STOP.items() for w in own if sum(w in o for o in _STOP.values()) == 1}
_NAMES = {x: re.compile(n, re.I) for x, n in LANGUAGE_NAMES.items()}
LANGS = tuple(STOPWORDS)


DENSE = 23
_NUMBER = re.compile(r"\d")


def stop_hashes() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words that only one language has, sorted, and the languages' numbers."""
    if not _STOPS:
        words = list(_ONLY)
        h = words_of([" ".join(words)])[0]
        order = np.argsort(h)
        _STOPS.append((h[order], np.array([LANGS.index(_ONLY[w]) for w in words])[order]))
    return _STOPS[0]


_STOPS: list[tuple[np.ndarray, np.ndarray]] = []


def by_language(row: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """How many words of each language every row has."""
    known, lang = stop_hashes()
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    hit = known[at] == words
    return np.bincount(row[hit] * len(LANGS) + lang[at[hit]], minlength=n * len(LANGS)).reshape(n, len(LANGS)).astype(float)


def rows_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash) of all words, (row, hash) of all pairs of neighbouring words."""
    words, _, count = words_of(texts)
    row = np.repeat(np.arange(len(texts)), count)
    pair = np.flatnonzero(row[1:] == row[:-1])
    return row, words, row[pair], mixed(words[pair] * U(0x100000001B3) + words[pair + 1])


def overlap(row_a: np.ndarray, a: np.ndarray, row_b: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row how many of a's are b's, each of b's used once and any number of times."""
    ua, ia, ca = np.unique(mixed(a ^ mixed(row_a.astype(U) + U(1))), return_index=True, return_counts=True)
    ub, cb = np.unique(mixed(b ^ mixed(row_b.astype(U) + U(1))), return_counts=True)
    _, x, y = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    rows = row_a[ia[x]]
    return np.bincount(rows, np.minimum(ca[x], cb[y]), n), np.bincount(rows, ca[x], n)


def features(pairs: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pair features, and of the hashed n-grams, scaled to length one: row, index, value); without how a response ends, which is joined."""
    n = len(pairs)
    x = np.zeros((n, DENSE), np.float32)
    asks, texts, plain, quoted = [], [], [], []
    for i, (prompt, content) in enumerate(pairs):
        text = content or ""
        if "<" in text:
            text = THOUGHT.sub(" ", text)
        bare = (TAG.sub(" ", text) if "<" in text else text).strip(" \t\r\n\v\f\xa0\u200b\ufeff:.`\"'[](){}<>*_-|/")
        says = bool(WORD.search(bare)) and not (len(bare) < 40 and bare.lower() in NOTHING)
        x[i, 0] = not says
        asks.append((prompt or "").lower())
        texts.append(text.lower() if says else "")
        x[i, 15] = says and bool(_NUMBER.search(text))
        if says and any(q in text for q in "\"“„«"):
            quoted.append(i)
            plain.append(QUOTED.sub(" ", text).lower())
    pr, pw, pgr, pg = rows_of(asks)
    cr, cw, cgr, cg = rows_of(texts)
    pn, cn, pgn, cgn = (np.bincount(r, minlength=n) for r in (pr, cr, pgr, cgr))
    # how much of the text each of the manners is in, by its sentences
    count = np.array([1 + sum(map(t.rstrip(" .!?\n").count, (". ", "! ", "? ", "; ", ": ", "\n"))) for t in texts])
    shares = np.minimum(manners_of([(cr, cw), (cgr, cg)], n) / count[:, None], 1)
    x[:, 16:21], x[:, 21], x[:, 22] = shares, (shares > 0.3).mean(axis=1), shares[:, 0] * shares[:, 1:].max(axis=1)
    both = (pn > 0) & (cn > 0)
    one, _ = overlap(cr, cw, pr, pw, n)
    two, loops = overlap(cgr, cg, pgr, pg, n)
    a, b, f, g = one / np.maximum(cn, 1), one / np.maximum(pn, 1), two / np.maximum(cgn, 1), two / np.maximum(pgn, 1)
    loops = np.maximum(f, loops / np.maximum(cgn, 1))  # a response may hold the prompt more than once
    x[:, 1], x[:, 2] = np.minimum(cn, 60) / 60, cn <= 3
    repeat = np.array([bool(REPEAT.search(p)) if t > 0.3 else False for p, t in zip(asks, loops)], float)
    for k, v in enumerate((a, b, f, g, np.minimum(loops, g), np.minimum(np.maximum(loops, a), b) ** 2, repeat, (1 - repeat) * np.minimum(loops, g) * (loops > 0.5)), 3):
        x[both, k] = v[both]
    lp, lc = by_language(pr, pw, n), by_language(cr, cw, n)
    if quoted:
        qr, qw, _, _ = rows_of(plain)
        lc[quoted] = by_language(qr, qw, len(plain))
    sure = both & (lc.sum(axis=1) >= 3) & (lp.sum(axis=1) >= 3)
    mine, best, own = lp.argmax(axis=1), lc.argmax(axis=1), lc / np.maximum(lc.sum(axis=1, keepdims=True), 1)
    every = np.arange(n)
    other = sure & (mine != best)
    asked = np.array([bool(o and _NAMES[LANGS[k]].search(p)) for o, k, p in zip(other, best, asks)], bool)
    x[sure, 11] = own[every, mine][sure]
    x[:, 12] = other & ~asked
    x[:, 13] = x[:, 12] * own[every, best]
    x[:, 14] = asked
    key, count = np.unique(np.concatenate([cr * HASHED + (cw % U(HASHED)).astype(np.int64), cgr * HASHED + (cg % U(HASHED)).astype(np.int64)]), return_counts=True)
    row, index = key // HASHED, key % HASHED
    length = np.sqrt(np.bincount(row, count.astype(float) ** 2, n))
    return x, row, index, count / length[row] if len(row) else count.astype(float)


def dense_of(pairs: list[tuple], extra: int = 0) -> np.ndarray:
    """All features as a matrix, for training, with so many more columns of zeros."""
    x, row, index, value = features(pairs)
    out = np.zeros((len(pairs), DENSE + HASHED + extra), np.float32)
    out[:, :DENSE] = x
    out[row, DENSE + index] = value
    return out


def scores_of(pairs: list[tuple], weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    x, row, index, value = features(pairs)
    s = x @ weights[:DENSE] + bias
    for k in range(s.shape[1]):
        s[:, k] += np.bincount(row, weights[DENSE + index, k] * value, len(pairs))
    return s


def refusal(rng: random.Random, lang: str, held: bool) -> str:
    """A refusal; those for calibration say what none of the others does, so that thresholds hold for phrases not trained on."""
    openings, every, whys, closings = REFUSALS[lang]
    opening, said, why, closing = rng.choice(openings), rng.choice(every[2::3] if held else [x for i, x in enumerate(every) if i % 3 != 2]), rng.choice(whys), rng.choice(closings)
    text = f"{opening} {said}".strip()
    return text[:1].upper() + text[1:] + why + "." + closing


def altered(rng: random.Random, prompt: str) -> str:
    """The prompt with a trivial change."""
    kind = rng.randrange(8)
    words = prompt.split(" ")
    if kind == 1:
        return f'"{prompt}"'
    if kind == 2:
        return rng.choice(["You asked: ", "Question: ", "Prompt: ", "Sure, here it is. ", "Frage: ", "Vous demandez : ", "Pregunta: "]) + prompt
    if kind == 3:
        return re.sub(r"[.,:;?!¿]", "", prompt)
    if kind == 4:
        return prompt.lower() if rng.random() < 0.5 else prompt.upper()
    if kind == 5:
        for _ in range(max(1, len(words) // 12)):
            words[rng.randrange(len(words))] = rng.choice(["this", "any", "some", words[0].lower()])
        return " ".join(words)
    if kind == 6:
        return prompt + "\n" + prompt
    if kind == 7:
        return prompt[: -1 if len(prompt) > 1 else None].strip() + rng.choice(["", "...", "!"])
    return prompt


def plain_pairs(n: int = 240) -> list[tuple]:
    """Sound pairs made of frequent and invented words, which are always trained on as well, as a small table has few; the same at every run."""
    rng = random.Random(5)
    coin = lambda: "".join(rng.choice("bdfgklmnprstv") + rng.choice("aeiou") for _ in range(rng.randrange(2, 4)))
    out = []
    for i in range(n):
        own = STOPWORDS[LANGS[i % len(LANGS)]].split()
        sentence = lambda k: " ".join(rng.choice(own) if rng.random() < 0.5 else coin() for _ in range(k)).capitalize()  # noqa: B023, E731
        out.append((-1 - i, sentence(14) + "?", " ".join(sentence(12) + "." for _ in range(rng.randrange(2, 6)))))
    return out


def training(sample: list[tuple]) -> list[tuple[str, str, str | None]]:
    """(prompt, content, defect or None) made of sampled pairs (id, prompt, content), the same at every run."""
    rng = random.Random(11)
    sample = sorted(sample)
    x = features([p[1:] for p in sample])[0]
    lang = by_language(*rows_of([(p[1] or "").lower() for p in sample])[:2], len(sample)).argmax(axis=1)
    base = [(p, c, LANGS[k]) for (_, p, c), y, k in zip(sample, x, lang) if p and c and len(c) > 80 and not y[0] and y[8] < 0.3 and not y[12] and y[1] > 0.2]
    by_lang = {x: [b for b in base if b[2] == x] for x in LANGS}
    made: list[tuple[str, str, str | None]] = []
    for prompt, content, lang in base:
        made.append((prompt, content, None))
        at = rng.randrange(len(content) // 4, len(content) - 1)
        short = content[:at].rstrip()
        if len(short) > 20:
            made.append((prompt, short + rng.choice(["", "", "", "…", "..."]), "truncated"))
        others = [x for x in LANGS if x != lang and by_lang[x]]
        other = rng.choice(by_lang[rng.choice(others)])[1] if others else None
        turn = rng.randrange(3)
        if turn == 0:
            made.append((prompt, altered(rng, prompt), "copied"))
            made.append((prompt, prompt + rng.choice(["\n\n", " "]) + content, None))
            made.append((prompt, rng.choice(HARMLESS) + " " + content, None))
        elif turn == 1:
            made.append((prompt, refusal(rng, lang if rng.random() < 0.7 else rng.choice(LANGS), len(made) % HELD == HELD - 1), "refusal"))
            made.append((prompt, rng.choice(SHORT), None))
            made.append((prompt, rng.choice(BLANKS), "empty"))
        elif other:
            made.append((prompt, rng.choice(["", "", "Sure, here it is. ", "Gerne, hier ist sie. ", "Bien sûr, la voici. ", "Claro, aquí está. "]) + other, "wrong_language"))
            quoted = other.split(". ")[0]
            made.append((prompt, f'The sign reads: "{quoted}." {content}', None))
            whole = [s for s in content.split(". ") if len(s) > 30][:2]
            if whole:
                made.append((f"{prompt} Now repeat the next sentences word for word and add nothing: {'. '.join(whole)}.", ". ".join(whole) + ".", None))
    return made


def fit(x: np.ndarray, y: np.ndarray, steps: int = 300, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of logistic heads, by full-batch steps with momentum and adaptive rates; the same at every run."""
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.full(y.shape[1], -2, np.float32)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    for t in range(1, steps + 1):
        error = (1 / (1 + np.exp(-(x @ w + b))) - y) / len(x)
        for p, g, m1, v1 in ((w, x.T @ error + decay * w, m, v), (b, error.sum(axis=0), mb, vb)):
            m1 += 0.1 * (g - m1)
            v1 += 0.01 * (g * g - v1)
            p -= rate * (m1 / (1 - 0.9**t)) / (np.sqrt(v1 / (1 - 0.99**t)) + 1e-8)
    return w, b


def calibrated(scores: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Per head the middle of the thresholds that give the most true decisions, a false alarm counting as two misses."""
    out = np.zeros(scores.shape[1], np.float32)
    for k in range(scores.shape[1]):
        order = np.argsort(-scores[:, k])
        gain = np.cumsum(np.where(y[order, k] > 0, 1, -2))
        top = gain == max(gain.max(), 0)
        at = np.flatnonzero(top)
        if not len(at):
            out[k] = scores[:, k].max() + 1
            continue
        s = scores[order, k]
        out[k] = (s[at[0]] + (s[at[0] + 1] if at[0] + 1 < len(s) else s[at[0]])) / 2
    return out


def defective(pairs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(id, defect): the defective pairs of pairs (id, prompt, content), one row each.

    A null or blank content, or one of marks, labels or thoughts only, is empty. A null prompt is empty text: nothing is copied from it or in
    another language than it. Rows with a null id are left out; ids are distinct. Of several defects the most certain is given.
    """
    spark = pairs.sparkSession
    pairs = pairs.where(F.col("id").isNotNull()).select(F.col("id").cast("bigint").alias("id"), "prompt", "content")
    texts = pairs.where(F.col("content").rlike(r"\w")).select("id", F.lit("assistant").alias("role"), F.col("content").alias("text"))
    found = keep(cuts.verdicts(texts))
    known = cuts.statistics(texts, found)
    ended = keep(cuts.scored(found, known).union(cuts.early_copies(texts)).distinct())

    rows = pairs.orderBy(F.xxhash64("id"), "id").limit(sample).join(F.broadcast(ended.withColumn("cut", F.lit(1))) if ended.limit(cuts.BROADCAST_IDS + 1).count() <= cuts.BROADCAST_IDS else ended.withColumn("cut", F.lit(1)), "id", "left").where("cut is null")
    taken = [tuple(r) for r in rows.select("id", "prompt", "content").collect()]
    made = training(taken + plain_pairs())
    own = spark.createDataFrame([(i, "assistant", c) for i, (_, c, _) in enumerate(made)], "id bigint, role string, text string")
    cut = {r[0] for r in cuts.scored(keep(cuts.verdicts(own)), known).collect()}
    x = dense_of([m[:2] for m in made], 1)
    x[:, -1] = [i in cut for i in range(len(made))]
    y = np.array([[m[2] == d for d in DEFECTS] for m in made], np.float32)
    held = np.arange(len(made)) % HELD == HELD - 1
    w, b = fit(x[~held], y[~held])
    limit = calibrated(x[held] @ w + b, y[held])
    del x, made, own, taken
    ending = w[-1]
    shared = spark.sparkContext.broadcast((w[:-1], b - limit))
    schema = pa.schema([("id", pa.int64()), ("s", pa.list_(pa.float32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                s = scores_of(list(zip(part.column("prompt").to_pylist(), part.column("content").to_pylist())), weights, bias)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(list(s), pa.list_(pa.float32()))], schema=schema)

    raw = pairs.mapInArrow(run, "id bigint, s array<float>").join(ended.withColumn("cut", F.lit(1.0)), "id", "left")
    margins = [F.struct((F.col("s")[k] + F.lit(float(ending[k])) * F.coalesce("cut", F.lit(0.0))).alias("m"), F.lit(d).alias("d")) for k, d in enumerate(DEFECTS)]
    best = raw.select("id", F.array_max(F.array(*margins)).alias("best"))
    return best.where("best.m > 0").select("id", F.col("best.d").alias("defect"))
