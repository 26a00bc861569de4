"""Trusted labels of lines: residue, sound, or unknown."""

from __future__ import annotations

import re

# Reason phrases of HTTP status codes 400 to 511.
REASONS = (
    "Bad Request|Unauthorized|Payment Required|Forbidden|Not Found|Method Not Allowed|Not Acceptable|Proxy Authentication Required|"
    "Request Timeout|Conflict|Gone|Length Required|Precondition Failed|Content Too Large|Payload Too Large|URI Too Long|"
    "Unsupported Media Type|Range Not Satisfiable|Expectation Failed|Misdirected Request|Unprocessable Content|Locked|Failed Dependency|Too Early|"
    "Upgrade Required|Precondition Required|Too Many Requests|Request Header Fields Too Large|Unavailable For Legal Reasons|"
    "Internal Server Error|Not Implemented|Bad Gateway|Service Unavailable|Gateway Timeout|HTTP Version Not Supported|"
    "Insufficient Storage|Loop Detected|Network Authentication Required"
)
# HTML element names that prose or answers may show.
TAGS = (
    "a|b|i|u|p|br|hr|em|li|ol|ul|td|th|tr|div|img|pre|sub|sup|body|code|form|head|html|link|main|meta|span|nav|table|tbody|thead|title|input|label|"
    "strong|script|style|button|noscript|h1|h2|h3|h4|h5|h6|think|thinking|answer|reasoning|tool|tools"
)

#: A field of a template that nothing was filled into, in the notations of common template languages.
FIELD = re.compile(
    r"\{\{[^{}\n]{1,60}\}\}|\{%[^{}\n]{1,60}%\}|[$#]\{[A-Za-z][\w.|]*\}|%\([A-Za-z]\w*\)[sdr]|(?<![\w%])%[A-Za-z][A-Za-z_]+%(?![\w%])"
    r"|(?<!\w)__[A-Za-z][A-Za-z_]*?[A-Za-z]__(?!\w)|@@[A-Za-z][A-Za-z_]+@@|<<[A-Za-z][A-Za-z_ ]+>>|(?<![\w|])\|[a-z][a-z_]+\|(?![\w|])"
    r"|\[\[[A-Za-z][A-Za-z_ ]+\]\]|\[[A-Z][A-Z_ ]{2,}\]|\[(?:[Ii]nsert|[Yy]our|[Rr]ecipient)\b[^\]\n]{0,40}\]|\[[a-z][a-z_]{2,}\](?!\()"
    r"|(?<![\\$#\w{%])\{[A-Za-z][A-Za-z_]+(?:\|[^{}\n]*)?\}(?!\})|<[A-Z][A-Z_ ]{2,}>|<[a-z]+(?:_[a-z]+)+>|<(?:[Yy]our|[Ii]nsert)\b[^<>\n]{1,40}>"
    rf"|<(?!(?:{TAGS})>)[a-z]{{3,}}>"
)
#: Who says such words talks about fields or shows one.
ABOUT = re.compile(r"jinja|mustache|handlebars|liquid|\brender|\bprints?\b|placeholder|syntax|\bvariable|snippet|platzhalter|espace réservé|marcador", re.I)
#: A request for a text with gaps.
ASKED = re.compile(r"\btemplate\b(?! engine)|\bgaps?\b|fill in|\bvorlage|\blücken|\bausfüllen|\bmodèle de (?:lettre|texte)|à remplir|à compléter|\bplantilla|\bhuecos|\brellenar", re.I)
CODE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]*`", re.S)
MATH = re.compile(r"\$(?:\\[A-Za-z]+|\{[^{}$\n]*[,\\])[^$\n]*\$|\\\(.*?\\\)|\\\[.*?\\\]")
QUOTED = re.compile(r'"[^"\n]*"|“[^”\n]*”|„[^“”\n]*[“”]|«[^»\n]*»')

#: What pages that need scripts, cookies or another browser name, and what they say of it, by language.
NEEDING = (
    (r"javascript|cookies?|scripts|scripting|browser",
     r"enabled?|activated?|allow(?:ed)?|turn(?:ed)? (?:it )?o(?:n|ff)|switch(?:ed)? (?:it )?o(?:n|ff)|accept|permit|needs?|requires?|required|disabled|blocked|not supported|unsupported|outdated|out of date|too old|without"),
    (r"javascript|cookies?|skripte?n?|scripte?n?|browser", r"aktivier\w*|(?:ein|aus)ge?schalte\w*|schalten|einschalten|erlaub\w*|zulassen|benötig\w*|erforder\w*|blockier\w*|deaktivier\w*|unterstütz\w*|veraltet\w*"),
    (r"javascript|cookies?|scripts|navigateur", r"activ(?:ez|er|és?|ée)|autoris(?:ez|er|és?)|bloque\w*|requis\w*|nécessit\w*|désactiv\w*|obsolète|pris en charge|accept(?:ez|er)"),
    (r"javascript|cookies?|scripts|navegador", r"activ(?:e|ar|ado|os)|habilit\w*|permit\w*|bloque\w*|requier\w*|necesit\w*|hacen? falta|desactivad\w*|obsolet\w*|compatible|acept(?:e|ar)"),
)
#: Checks of the visitor, and what else such pages ask for.
SAID = re.compile(
    r"(?:one moment|just a moment|please wait)\b.*\b(?:check\w*|verif\w*|robot|human)\b.*|.*\b(?:checking|verify(?:ing)?|confirm(?:ing)?|prove|make sure|making sure)\b.{0,30}\b(?:you are|you're|your (?:browser|connection))\b.*|are you (?:a )?(?:robot|human)"
    r"|(?:.*\b)?(?:reload|refresh) (?:the|this) page\b.*|(?:access|permission) denied",
    re.I,
)
#: A speaker of their own, or a question: such a sentence is not a page's.
SPEAKER = re.compile(r"\b(?:I|me|my|we|us|ich|mir|mich|wir|je|me|moi|nous|yo|mi|nosotros|he|she|they)\b|\bI['’]|[?]\W*$", re.I)
#: Most characters of a page's sentence.
SENTENCE_SIZE = 160
_CODE = rf"(?:(?:HTTP(?:/\d(?:\.\d)?)?|Error|Fehler|Erreur|Status|Code)[ :]*[45]\d\d[ :,.–-]*(?:{REASONS})?|[45]\d\d[ :,.–-]+(?:{REASONS})|(?:{REASONS}))"
#: Lines of error pages by their form: a status, a page's source, an identity.
ERROR = re.compile(rf"{_CODE}[.!]?|.*<title>[45]\d\d .*|(?:request id|ref(?:erence)?)[ :]*[0-9a-f]{{6,}}", re.I)
#: Forms that a page's sentence stands in; what it is, is learned from them.
FRAMES = [
    re.compile(x, re.I)
    for x in (
        rf"(?:{_CODE})\. (?P<said>.{{3,160}}?)\s*\b(?:reference|ref|request id|ray id|incident)\W+\w+\W*",
        r"(?:oops|whoops|sorry|uh-oh|ups|hoppla)\W+(?P<said>.{3,160}?)\s*\((?:(?:error|status) )?(?:code )?\d{3}\)",
        rf"(?:HTTP(?:/\d(?:\.\d)?)?|Error|Fehler|Erreur)[ :]*[45]\d\d[ :,.–-]+(?P<said>.{{3,160}})",
    )
]
_FILLS = "|".join(
    (
        # invented Latin, keys pressed at random, one word again and again
        r"lorem ipsum(?: \w+){2,}[^.!?]*", r"(?:asdf|qwer|qwertz?y?|jkl|foo|bar|baz|qux|blah|bla)(?:[ ,]+(?:asdf|qwer|qwertz?y?|jkl|foo|bar|baz|qux|blah|bla))+", r"x{3,}(?: x{3,})*", r"(?:text|test|words?|content|sample)(?:[ ,]+(?:text|test|words?|content|sample|\d+)\b){2,}",
        # what says that something is still to come
        r"tb[dac]|to be (?:added|announced|defined|determined|written)|(?:todo|fixme)(?:: (?:write|add|fill|insert)\b[^.!?\n]{0,60})?", r"\(?(?:content|text|copy|description|details)\b (?:will be|to be|is|are|coming|goes|follows?|to follow)\b[^.!?)]{0,40}\)?",
        r"(?:your|the|some) (?:text|content|copy|title|name|message|description) (?:goes|comes|will go|belongs) here", r"insert\b[^.!?]{0,60}\b(?:text|content|greeting|body|message|title|name|image|paragraph|description|caption|headline|copy)\b[^.!?]{0,30}",
        # what calls itself a stand-in, by language
        r"(?:this is )?(?:an? )?(?:placeholder|dummy|sample|filler|stand-in) (?:text|copy|content|paragraph|sentence|image)\b[^.!?]{0,40}",
        r"(?:hier|an dieser stelle) (?:steht|kommt|folgt|erscheint)\b[^.!?]{0,30}\b(?:text|inhalt|beschreibung)\w*[^.!?]{0,15}|(?:platzhalter|blind|muster|füll|beispiel)text\w*\b[^.!?]{0,40}",
        r"texte (?:provisoire|factice|de remplissage|de substitution|d['’]exemple|à (?:remplacer|compléter|venir))\b[^.!?]{0,40}|votre texte ici|contenu à (?:venir|compléter)",
        r"texto (?:provisional|ficticio|de (?:relleno|ejemplo|muestra|prueba))\b[^.!?]{0,40}|(?:su|tu) texto aquí|(?:aquí va|aquí irá) (?:su|tu|el) (?:texto|contenido)\b[^.!?]{0,20}|contenido (?:pendiente|por venir)",
    )
)
FILLER = re.compile(rf"(?:{_FILLS})(?:\W+(?:{_FILLS}))*", re.I)
SENTENCE = re.compile(r"(?<=[.!?…])\s+")
#: Who asks about such texts, or for one, gets it.
WANTED = re.compile(r"\blorem\b|placeholder|filler|dummy text|sample text|error (?:page|message)s?|platzhalter|blindtext|fehler(?:seite|meldung)|remplissage|(?:page|message) d['’]erreur|relleno|(?:página|mensaje) de error", re.I)
#: What a line must hold for a rule to apply; the others are unknown at once.
OPEN = re.compile(r"[{<\[%|]|__|@@")
#: Words in lower case; no page's or filler's sentence is without one of them.
CUE = re.compile(
    r"javascript|cookie|\bscripts\b|scripting|\b[sc]kripte|\bscripte|browser|navigateur|navegador|robot|human|your connection|(?:reload|refresh) th|"
    r"lorem|asdf|qwer|\bfoo\b|\bblah?\b|xxx|text text|test test|\b(?:text|test|words?|sample|content)\b[ ,]+\d+|word word|\btb[dac]\b|to be (?:added|announced|defined|determined|written)|\btodo\b|fixme|(?:content|text|copy|description|details) (?:will|to|is|are|coming|goes|follows?|comes|belongs)\b|"
    r"\b(?:goes|comes|go|belongs) here|\binsert\b|placeholder|(?:dummy|sample|filler|stand-in) (?:text|copy|content|paragraph|sentence|image)|(?:hier|stelle) (?:steht|kommt|folgt|erscheint)|(?:platzhalter|blind|muster|füll|beispiel)text|texte (?:provis|factice|de rempl|de subst|d['’]ex|à )|texte ici|contenu à|texto (?:provis|fictic|de )|texto aquí|aquí (?:va|irá)|contenido p|"
    rf"\b(?:http(?:/\d(?:\.\d)?)?|error|fehler|erreur|status|code)[ :]*[45]\d\d|{REASONS.lower()}|[45]\d\d[ :,.–-]+(?:{REASONS.lower()})|oops|request id|\bref(?:erence)?[ :]+[0-9a-f]|incident|ray id|(?:access|permission) denied",
)


def _pairs(kinds: tuple[tuple[str, str], ...]) -> list[tuple[re.Pattern, re.Pattern]]:
    return [(re.compile(rf"\b(?:{x})\b", re.I), re.compile(rf"\b(?:{y})\b", re.I)) for x, y in kinds]


_BOTH = _pairs(NEEDING)
#: A word of these is in every sentence that SAID or NEEDING tells.
_PART = re.compile(r"javascript|cookie|script|skript|browser|navigateur|navegador|you|robot|human|page|denied|wait|moment", re.I)
_TRIM = " .!?…\"'“”„«»()*_>-"


def is_page(sentence: str) -> bool:
    """Whether a sentence is one that a failing or demanding page shows."""
    if ERROR.fullmatch(sentence):
        return True
    if len(sentence) > SENTENCE_SIZE or not _PART.search(sentence):
        return False
    return bool(SAID.fullmatch(sentence)) or not SPEAKER.search(sentence) and any(x.search(sentence) and y.search(sentence) for x, y in _BOTH)


def told(line: str) -> bool:
    """Whether the line is filler or every sentence of it one of a page's."""
    if FILLER.fullmatch(line.strip(_TRIM)):
        return True
    parts = [p.strip(_TRIM) for p in SENTENCE.split(line)]
    parts = [p for p in parts if p]
    return bool(parts) and all(FILLER.fullmatch(p) or is_page(p) for p in parts) or any(f.fullmatch(line.strip()) for f in FRAMES)


def framed(line: str) -> list[str]:
    """The sentences that stand in a form of an error page."""
    if (m := re.search(r"<title>[45]\d\d\b.*", line, re.I)) is not None:
        inner = re.findall(r"<(?:p|h1|h2|div)>([^<>]{3,160})<", m[0], re.I)
    else:
        inner = [m["said"] for f in FRAMES if (m := f.fullmatch(line.strip()))]
    return [p for x in inner for p in SENTENCE.split(x) if len(p.split()) > 2]


def filler_within(line: str) -> list[str]:
    """Sentences of filler in a line that says other things as well."""
    return [p for p in SENTENCE.split(line) if len(p) > 12 and FILLER.fullmatch(p.strip(_TRIM))]


#: Labels: residue that other sentences are held against, residue, sound; 0 is unknown.
SEED, FOUND, SOUND = 2, 1, -1


def labels(role: str | None, text: str | None, before: str | None, cued: bool = True) -> list[tuple[str, int]]:
    """(line, SEED | FOUND | 0 | SOUND) of a message; before is the user turn it answers, cued tells whether CUE may be in it.

    Code, formulas and JSON of tools are no lines. A line with a field is found, but nothing is learned from it; it is sound where the message
    talks about fields, quotes one, or supplies a text with gaps that was asked for. Lines of pages and filler are sound where they
    were asked for or about. Behind a line stand, as lines of their own that begin with a tab, the sentences of pages and filler within it.
    """
    if not text or (role == "tool" and text.lstrip()[:1] in ("{", "[")):
        return []
    plain = CODE.sub(" ", text) if "`" in text else text
    plain = MATH.sub(" ", plain) if "$" in plain or "\\" in plain else plain
    lines = [y for x in plain.splitlines() if (y := x.strip())]
    asked = None
    wanted = role == "assistant" and bool(before and WANTED.search(before)) and not any(map(told, before.splitlines()))
    out: list[tuple[str, int]] = []
    for x in lines:
        field, cue = OPEN.search(x), cued and CUE.search(x.lower())
        if not field and not cue:
            out.append((x, 0))
            continue
        if asked is None:
            asked = bool(before and ASKED.search(before)) or bool(ASKED.search(lines[0]) and lines[0].endswith(":"))
        flat = re.sub(r"</?[a-z][a-z0-9]*>", " ", x).strip() if "<" in x else x
        item = x[:1] in "-*•+#" or x[:1] in "\"“„«"
        if cue and not item and (told(flat) or ERROR.fullmatch(x)):
            inner = framed(x)
            out.append((x, SOUND if wanted else FOUND if inner else SEED))
            out += [("\t" + p, SEED) for p in inner if not wanted]
        elif field and FIELD.search(x):
            bare = QUOTED.sub(" ", x)
            parts = [s for s in SENTENCE.split(bare) if FIELD.search(s)]
            out.append((x, FOUND if parts and not asked and not any(ABOUT.search(s) for s in parts) else SOUND))
        else:
            inner = filler_within(QUOTED.sub(" ", x)) if cue and not item else []
            out.append((x, 0 if not inner else SOUND if wanted else FOUND))
            out += [("\t" + p, SEED) for p in inner if not wanted]
    return out


_HEX, _NUMBER = re.compile(r"\b(?=\w*\d)[0-9a-f]{6,}\b"), re.compile(r"\d+(?:[.,]\d+)*")


def normal(line: str) -> str:
    """The line as it is compared: numbers and ids are all alike, and so are fields, which are words of their own."""
    return _NUMBER.sub("0", _HEX.sub("0", (FIELD.sub(" ʭ ", line) if OPEN.search(line) else line).lower()))
