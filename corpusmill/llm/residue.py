"""Template residue and error-page text: records whose title or body holds unfilled spots, filler, errors or calls to turn on scripts.

1. Exemplars of residue are labelled by hand (EXEMPLARS, in five languages), and so are passages that look alike but are content (COUNTER_EXAMPLES);
   another set may be given as pairs (kind, text). An inverted index leads from a word to the exemplars that hold it; every task has the set.
2. Every title and every sentence of a body is a passage window; so are the parts of a title between bars, dashes with blanks and the like, where site
   names stand, and the parts between bars of a sentence. What a colon parts is mostly one headline ('Just a moment: ...'), so there only values that
   a program left (undefined, NaN ...) count. A part that is only a number counts in titles alone, as an error's code. Unfilled spots ({{name}}, ${x}, [INSERT DATE], __CITY__ ...) become one word of
   their own, <slot>; numbers other than HTTP's error codes are left out.
3. One pass over the texts counts in how many records each word of the exemplars stands, and keeps the windows that could be residue: those with a
   slot, and those of whose words at least MIN_KNOWN are exemplars' words. Weights are logarithms, none above twice the one that unknown words get,
   so a window with fewer can't reach step 4's coverage.
4. Words weigh by inverse document frequency over all records of all tables. A window is residue if one exemplar covers at least MIN_COVERAGE of
   the window's weight and the window at least MIN_CONTAINED of the exemplar's; exemplars of loose vocabulary (lorem ipsum) need the first
   only, with MIN_LOOSE words. A window between wordings is residue if a few exemplars of one kind cover it together (`Scorer.together`). A <slot> is
   residue by itself. A window that a counterexample covers better is content, and so are the parts of one
   that a counterexample covers.

The pass reads rows where they lie; only word counts of the exemplars' vocabulary (a constant size) are brought together, and nothing else is
shuffled but the found keys.

Defined results: a null or empty title or body is no case. Whole texts are read, however long. Ties between exemplars take the first. Rows repeated
in the input give one result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.cluster import materialize

MIN_COVERAGE, MIN_CONTAINED, MIN_LOOSE, MIN_KNOWN = 0.72, 0.6, 3, 0.55
#: A wording between exemplars: at most MOST_PARTS of one kind together must cover so much of a window, each with so much of its own weight in it (more where
#: the window is one word); the two rarest covered words weigh so much of an unknown word's weight; words stand in pairs as in the exemplars, or nearly all is covered.
MIN_UNION, MOST_PARTS, MIN_PART, MIN_ONE, MIN_RARITY, MIN_ALONE = 0.62, 6, 0.15, 0.5, 0.5, 0.75
SLOT_KIND, STEM = "slot", 7
#: The word that stands for an unfilled spot.
SLOT = "xslotx"

# Residue by kind, labelled by hand: common wordings of content systems, servers and browsers in five languages. Another set can be given to every
# function as pairs (kind, text).
EXEMPLARS: dict[str, list[str]] = {
    "slot": [SLOT],
    "loose": [
        "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum",
        "asdf asdf qwerty test test please ignore",
        "dummy copy dummy copy dummy text dummy text placeholder copy placeholder text",
        "tk tk tk copy to come from marketing tbd",
    ],
    "filler": [
        "This is sample text", "This is placeholder text replace it with your own content before publishing", "Text block placeholder do not publish", "Draft do not publish", "Your headline goes here", "Your text goes here", "Content goes here", "Heading goes here", "Image caption goes here", "Insert your text here", "Insert title here",
        "I'm a paragraph", "Click here to add your own text and edit me", "Add your own content here", "Use this space to tell visitors who you are and what you do", "Describe the feature in a sentence or two", "Add a short description of the service", "Write a short description of your business here", "Sample service title", "Title text here subtitle text here",
        "Just another site built with our starter kit", "Just another site", "Hello world Welcome to your first post", "Welcome to WordPress this is your first post edit or delete it then start writing", "This is an example page", "This page is under construction", "Site under construction please check back soon", "Coming soon", "Content coming soon", "Placeholder text",
        "Untitled", "Untitled document", "New post edit me", "Your Blog Post Title", "Sample Page", "Sample Post", "Blog Post Template", "Copy of Blog Post Template", "Copy of template", "Post title", "Title goes here", "Test post please ignore",
        "Hier steht Ihr Text", "Dies ist ein Beispieltext bitte ersetzen", "Votre texte ici", "Ceci est un texte d'exemple à remplacer", "Escriba aquí su texto", "Texto de ejemplo", "Seu texto aqui", "Texto de exemplo",
    ],
    "rendering": [
        "undefined", "null", "NaN", "Welcome undefined", "Your adviser is null", "Posted by null on Invalid Date", "Invalid Date", "undefined undefined joined the team in NaN", "Fees start at NaN per year for object Object", "object Object", "Error cannot render", "Cannot read properties of undefined",
    ],
    "error": [
        "404", "403", "500", "502", "503", "504", "Page not found", "404 Not Found", "404 page not found", "Not Found", "Error 404", "400 Bad Request", "500 Internal Server Error", "502 Bad Gateway", "503 Service Unavailable", "504 Gateway Timeout", "403 Forbidden", "410 Gone",
        "The requested URL was not found on this server", "Your browser sent a request that this server could not understand", "You don't have permission to access this resource on this server", "Access denied", "You do not have permission to view this resource", "You are not authorized to view this page",
        "The server encountered an internal error and was unable to complete your request", "The upstream server returned an invalid response", "The server did not respond in time", "The server is temporarily unable to service your request due to maintenance downtime or capacity problems", "The service is temporarily unavailable due to maintenance please try again later", "We are down for scheduled maintenance and will be back soon",
        "Web server is down", "The web server reported an error", "Error establishing a database connection", "Database error", "Fatal error uncaught exception thrown in php on line", "Fatal error Uncaught TypeError in srv web theme php", "Warning include header php failed to open stream no such file or directory in srv web index php on line", "Application error a client side exception has occurred",
        "The request took too long and was cancelled", "Request timed out", "The connection has timed out", "This site can't be reached", "Server not found", "Too many requests", "Your session has expired please log in again", "Request blocked", "Your request was blocked by our security service", "Retry",
        "Something went wrong on our end", "Something went wrong", "Oops something went wrong", "An unexpected error occurred", "An error occurred while processing your request", "Please try again in a few minutes", "Please try again later", "Incident id", "Hmm there is nothing at this location", "Nothing was found at this location", "Nothing here",
        "Sorry this page isn't available", "Sorry we looked everywhere and this address leads nowhere", "We can't find the page you are looking for", "The page you are looking for does not exist or has been moved", "The page you requested could not be found", "Oops That page can't be found", "That page can't be found", "This page is no longer available", "This content is no longer available", "The link you followed may be broken or the page may have been removed", "It may have been moved renamed or removed", "Check the address and try again", "Try the menu above or search", "Go back to the homepage", "Return to the home page",
        "This account has been suspended", "Account suspended", "Contact your hosting provider for details", "This website has been disabled by its owner", "this content has been withdrawn by its owner", "This domain has expired", "This domain is parked",
        "Seite nicht gefunden", "Die gesuchte Seite wurde nicht gefunden", "Diese Seite existiert leider nicht mehr oder wurde verschoben", "Zurück zur Startseite", "Zugriff verweigert", "Interner Serverfehler", "Ein Fehler ist aufgetreten bitte versuchen Sie es später erneut",
        "Page introuvable", "La page demandée n'existe pas ou a été déplacée", "La page que vous recherchez est introuvable", "Retour à l'accueil", "Accès refusé", "Une erreur est survenue veuillez réessayer plus tard",
        "Página no encontrada", "No se encontró la página solicitada", "Lo sentimos la página que buscas no está disponible o ya no existe", "Volver al inicio", "Acceso denegado", "Ha ocurrido un error inténtelo de nuevo más tarde",
        "Página não encontrada", "A página que você procura não existe ou foi movida", "Voltar para a página inicial", "Acesso negado", "Ocorreu um erro tente novamente mais tarde",
    ],
    "script": [
        "You need to enable JavaScript to run this app", "Please enable JavaScript to view this page", "Please enable JavaScript in your browser", "Enable JavaScript and cookies to continue", "JavaScript seems to be disabled in your browser", "JavaScript must be turned on for this website to work properly", "Turn it on for the full experience", "Your browser is not supported", "Your browser does not support JavaScript or it is switched off", "Please upgrade to a modern browser", "Unsupported browser", "Your browser is out of date", "This site requires JavaScript and cookies",
        "Scripting is required to use the client portal", "This site relies on scripts your browser has them switched off", "This content needs scripts that are blocked", "Checking your browser before you continue", "Checking your browser before accessing", "This usually takes a few seconds", "Just a moment", "Please wait while scripts load", "Loading please wait", "One moment please", "Please wait while we verify that you are human", "Verify you are human to continue", "Please complete the captcha to continue", "This page requires JavaScript", "JavaScript is required", "Please turn on JavaScript",
        "Bitte aktivieren Sie JavaScript um fortzufahren", "Bitte aktivieren Sie JavaScript in Ihrem Browser", "Votre navigateur doit exécuter JavaScript pour afficher ce contenu", "Veuillez activer JavaScript pour continuer", "Active JavaScript para continuar", "Por favor habilite JavaScript en su navegador para ver esta página", "Ative o JavaScript no seu navegador para continuar", "Ce site nécessite JavaScript pour fonctionner", "Diese Website benötigt JavaScript", "Este sitio requiere JavaScript", "Este site requer JavaScript",
    ],
}
# Content that talks about such things or shows a form to copy.
COUNTER_EXAMPLES = [
    f"The sample letter opens Dear {SLOT} and runs to a single page you can adapt", f"The sample letter opens Dear {SLOT}", f"Write Dear {SLOT} at the top of the letter and sign it", "Fill in the blank lines on the beneficiary form and have two witnesses sign", "Not found on the statement",
]
Pairs = tuple[tuple[str, str], ...]
DEFAULT: Pairs = (*((kind, t) for kind, texts in EXEMPLARS.items() for t in texts), *(("content", t) for t in COUNTER_EXAMPLES))

#: Unfilled spots of templates. A pair of braces counts with one name or number in it, a pair of square brackets with capitals or a call to fill it.
SLOT_RE = (
    r"\{\{[^{}\n]{0,80}\}\}|\{%[^%\n]{0,80}%\}|<%[^%\n]{0,80}%>|[$#]\{[^{}\n]{1,80}\}|\[\[[^\[\]\n]{1,80}\]\]|%%\w{2,40}%%|%[a-z][a-z_]{1,40}%|__[A-Z][A-Z0-9_]{1,40}__|\{[A-Za-z][A-Za-z0-9]*(?:[_.][A-Za-z0-9]+)+\}|\{[0-9]{1,2}\}"
    r"|\[(?:INSERT|Insert|insert|YOUR|Your|your|ADD|Add|ENTER|Enter)\b[^\[\]\n]{0,60}\]|\[[A-Z][A-Z0-9]*(?:[ _][A-Z0-9]+)*\]|\[[^\[\]\n]{0,60}(?:TBD|TODO|XXX|here)\]|\[[a-z]+(?: [a-z]+)* (?:name|date|address|number)\]"
    r"|<(?:Your|YOUR|your|Insert|INSERT|Enter)\b[^<>\n]{0,60}>|<(?:title|TITLE|headline|name)>|\*\|[A-Z_]{2,40}\|\*|@@[A-Za-z_]{2,40}@@|&lt;[A-Za-z][A-Za-z0-9]*[_ .][A-Za-z0-9_ .]{1,40}&gt;|(?:^|\s)%[sd]\b|<<[A-Za-z_ ]{2,40}>>|«[a-z_]{2,40}»|\{[A-Za-z]{2,30}\}|\$NaN\b|\[object Object\]"
)


#: What any unfilled spot has; texts without it needn't be searched for spots.
_SLOT_SIGN = r"[{\[<«]|&lt;|%%|%[a-z]|__|@@|\*\||\$NaN"


def _windows(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The passage windows of each text, and the row that each belongs to."""
    return _split(_lower(_slotted(texts)), r"\n+|[.?!…]+[\"”)*_]*\s+")


def _slotted(texts: pa.Array) -> pa.Array:
    t = pc.fill_null(texts, "")
    signs = pc.match_substring_regex(t, _SLOT_SIGN)
    return pc.replace_with_mask(t, signs, pc.replace_substring_regex(t.filter(signs), SLOT_RE, f" {SLOT} "))


def _split(texts: pa.Array, at: str) -> tuple[pa.Array, np.ndarray]:
    """The pieces of each text, and the row that each belongs to."""
    pieces = pc.split_pattern_regex(texts, at)
    return pieces.flatten(), np.repeat(np.arange(len(texts)), np.diff(pieces.offsets.to_numpy()))


_BAR, _DASH, _COLON = r"\s*\|\s*", r"\s+[-–—•·»/]+\s+", r":\s+"
#: Where titles and sentences are cut into parts. The last kind of cut only shows values that a program left.
TITLE_CUTS, SENTENCE_CUTS = {"part": f"{_BAR}|{_DASH}", "colon": f"{_BAR}|{_DASH}|{_COLON}"}, {"part": _BAR}


def _parts(windows: pa.Array, cuts: dict[str, str], numbers: bool) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """(cut, parts, the window that each is of) for each kind of cut; numbers: a part without letters may be one number."""
    for cut, at in cuts.items():
        cuttable = np.flatnonzero(pc.match_substring_regex(windows, at).to_numpy(zero_copy_only=False))
        parts, of = _split(windows.take(pa.array(cuttable)), at)
        ok = pc.match_substring_regex(parts, r"\p{L}|^\s*[0-9]+\s*$" if numbers else r"\p{L}").to_numpy(zero_copy_only=False)
        yield cut, parts.filter(pa.array(ok)), cuttable[of[ok]]


def _lower(texts: pa.Array) -> pa.Array:
    """Lower case, without apostrophes."""
    return pc.replace_substring(pc.replace_substring(pc.utf8_lower(texts), "’", ""), "'", "")


def _tokens(windows: pa.Array) -> pa.Array:
    return pc.split_pattern_regex(windows, r"[^\p{L}\p{N}]+")


def _stems(words: pa.Array) -> pa.Array:
    """Words by their first STEM letters: disabled and disable, requested and request are one."""
    return pc.utf8_slice_codeunits(words, 0, STEM)


_CODES = {"403", "404", "410", "500", "502", "503", "504"}


def _solid(flat: pa.Array) -> np.ndarray:
    """Which words count: numbers don't, but for error codes."""
    numeric = pc.and_(pc.utf8_is_decimal(flat), pc.invert(pc.is_in(flat, value_set=pa.array(sorted(_CODES)))))
    return pc.and_(pc.not_equal(flat, ""), pc.invert(numeric)).to_numpy(zero_copy_only=False)


def _plain(texts: list[str]) -> list[list[str]]:
    """The counting words of each text; all are split in one call, as every call compiles its expressions anew."""
    split = _tokens(_lower(pa.array(texts, pa.string())))
    flat, ends = split.flatten(), split.offsets.to_pylist()
    words, solid = _stems(flat).to_pylist(), _solid(flat).tolist()
    return [[w for w, ok in zip(words[a:b], solid[a:b], strict=True) if ok] for a, b in zip(ends, ends[1:], strict=False)]


class Exemplars:
    """The labelled passages, their vocabulary and inverted index."""

    def __init__(self, pairs: Pairs = DEFAULT) -> None:
        self.kind, self.words = [SLOT_KIND], [[SLOT]]
        for (kind, _), ws in zip(pairs, _plain([t for _, t in pairs]), strict=True):
            if ws and ws != [SLOT]:
                self.kind.append(kind)
                self.words.append(ws)
        self.vocabulary = sorted({w for ws in self.words for w in ws})
        number = {w: k for k, w in enumerate(self.vocabulary)}
        self.ids = [sorted({number[w] for w in ws}) for ws in self.words]
        self.pairs = [{(number[x], number[y]) for x, y in zip(ws, ws[1:], strict=False)} for ws in self.words]
        self.holding: list[list[int]] = [[] for _ in self.vocabulary]
        for e, ids in enumerate(self.ids):
            for i in ids:
                self.holding[i].append(e)
        self.slot = number[SLOT]
        self.values = pa.array(self.vocabulary)


def _batch_ids(ex: Exemplars, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word id, window) of all counting words, and the row of each window; words outside the vocabulary have id len(vocabulary)."""
    windows, row = _windows(texts)
    return *_word_ids(ex, windows), row


def _word_ids(ex: Exemplars, windows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word id, window) of all counting words. What stands between blanks is split into words once for equal ones."""
    split = pc.split_pattern(windows, " ")
    coded = pc.dictionary_encode(split.flatten())
    of_piece = np.repeat(np.arange(len(windows)), np.diff(split.offsets.to_numpy()))
    words = _tokens(coded.dictionary)
    flat, m = words.flatten(), len(coded.dictionary)
    of = np.repeat(np.arange(m), np.diff(words.offsets.to_numpy()))
    ok = _solid(flat)
    ids = pc.fill_null(pc.index_in(_stems(flat), value_set=ex.values), len(ex.vocabulary)).to_numpy(zero_copy_only=False).astype(np.int64)
    at, place = _spread(of[ok], coded.indices.to_numpy(), m)
    return ids[ok][at], of_piece[place]


def _maybe(ex: Exemplars, ids: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Which of n windows could be residue."""
    whole = np.bincount(of, minlength=n)
    known = np.bincount(of, ids < len(ex.vocabulary), minlength=n)
    return (whole > 0) & ((np.bincount(of, ids == ex.slot, minlength=n) > 0) | (known >= MIN_KNOWN * whole))


def _lists_of(ids: np.ndarray, of: np.ndarray, which: np.ndarray, n: int) -> pa.Array:
    """The word numbers of some of n windows, in the order of which."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
    return lists.take(pa.array(which))


_WINDOWS = "src string, recs array<bigint>, window array<int>, cut string, whole array<int>, word int, n bigint"


def _spread(of: np.ndarray, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For the places of codes, where each stands for one of n lists that lie one after another: (place in the lists, place in codes) of every item."""
    sizes = np.bincount(of, minlength=n)
    starts, each = np.concatenate([[0], np.cumsum(sizes)])[codes], sizes[codes]
    before = np.cumsum(each) - each
    at = np.repeat(np.arange(len(codes)), each)
    return np.arange(len(at)) - before[at] + starts[at], at


def _grouped_windows(records: DataFrame, exemplars: Pairs) -> DataFrame:
    """Written once: what `candidate_windows` gives, with the records of equal windows of a batch in one row: recs. Words are looked up once for equal windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ex = Exemplars(exemplars)
        n_words = len(ex.vocabulary)
        df, n = np.zeros(n_words, np.int64), 0

        def rows(src: pa.Array, recs: pa.Array, ends: np.ndarray, windows: pa.Array, cut: str | None, whole: pa.Array | None) -> pa.RecordBatch:
            k = len(src)
            return pa.RecordBatch.from_pydict({
                "src": src, "recs": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), recs), "window": windows, "cut": pa.array([cut] * k, pa.string()), "whole": pa.nulls(k, pa.list_(pa.int32())) if whole is None else whole,
                "word": pa.nulls(k, pa.int32()), "n": pa.nulls(k, pa.int64()),
            })

        for b in batches:
            windows, row = _windows(b.column(2))
            coded = pc.dictionary_encode(windows)
            codes, m = coded.indices.to_numpy(), len(coded.dictionary)
            ids, of = _word_ids(ex, coded.dictionary)
            n += b.num_rows
            if not len(ids):
                continue
            known = ids < n_words
            at, place = _spread(of[known], codes, m)
            held = np.zeros((b.num_rows, n_words), bool)
            held[row[place], ids[known][at]] = True
            df += held.sum(0)
            found = np.flatnonzero(_maybe(ex, ids, of, m)[codes])
            src = pc.dictionary_encode(b.column(0), null_encoding="encode")
            key = codes[found].astype(np.int64) * len(src.dictionary) + src.indices.to_numpy()[row[found]]
            order = np.argsort(key, kind="stable")
            groups, starts = np.unique(key[order], return_index=True)
            yield rows(src.dictionary.take(pa.array(groups % len(src.dictionary))), b.column(1).take(pa.array(row[found][order])), np.append(starts, len(found)), _lists_of(ids, of, groups // len(src.dictionary), m), None, None)
            titles = _lower(_slotted(b.column(3)))
            for wholes, row_of, cuts, numbers in ((windows, row, SENTENCE_CUTS, False), (titles, np.arange(b.num_rows), TITLE_CUTS, True)):
                for cut, parts, whole in _parts(wholes, cuts, numbers):
                    ids_p, of_p = _word_ids(ex, parts)
                    found = np.flatnonzero(_maybe(ex, ids_p, of_p, len(parts)))
                    if len(found):
                        own = whole[found]
                        place = pa.array(row_of[own])
                        ids_w, of_w = _word_ids(ex, wholes.take(pa.array(own)))
                        yield rows(b.column(0).take(place), b.column(1).take(place), np.arange(len(own) + 1), _lists_of(ids_p, of_p, found, len(parts)), cut, _lists_of(ids_w, of_w, np.arange(len(own)), len(own)))
        held = np.flatnonzero(df)
        words = [*held.tolist(), -1]
        k = len(words)
        none = pa.nulls(k, pa.list_(pa.int32()))
        yield pa.RecordBatch.from_pydict({"src": pa.nulls(k, pa.string()), "recs": pa.nulls(k, pa.list_(pa.int64())), "window": none, "cut": pa.nulls(k, pa.string()), "whole": none, "word": pa.array(words, pa.int32()), "n": pa.array([*df[held].tolist(), n], pa.int64())})

    title = F.col("title") if "title" in records.columns else F.lit(None).cast("string").alias("title")
    return materialize(records.select("src", F.col("rec_id").cast("bigint").alias("rec_id"), "text", title).mapInArrow(run, _WINDOWS))


def candidate_windows(records: DataFrame, exemplars: Pairs = DEFAULT) -> DataFrame:
    """(src, rec_id, window, cut, whole) of the windows that could be residue, as word numbers, for parts with the kind of cut and the
    window they are of; and (word, n) of the records that hold a word, with word -1 for all records."""
    return _grouped_windows(records, exemplars).select("src", F.explode_outer("recs").alias("rec_id"), "window", "cut", "whole", "word", "n")


class Scorer:
    def __init__(self, df: np.ndarray, n: int, ex: Exemplars | None = None):
        self.ex = ex or Exemplars()
        idf = np.log1p(n / (1.0 + df)) if n else np.ones(len(df))
        self.weight = np.append(idf, max(np.median(idf), idf.max() / 2))
        self.mass = [self.weight[i].sum() for i in self.ex.ids]

    def judge(self, window: tuple[int, ...]) -> tuple[str, float]:
        """(kind, coverage) of a window; at once '' if the exemplars' words carry too little of its weight."""
        known = sum(self.weight[i] for i in window if i < len(self.ex.vocabulary))
        whole = sum(self.weight[i] for i in window)
        return self.best(list(window)) if self.ex.slot in window or known >= MIN_COVERAGE * whole else ("", 0.0)

    def judge_part(self, part: tuple[int, ...], cut: str, whole: tuple[int, ...]) -> tuple[str, float]:
        """(kind, coverage) of a part of a window."""
        kind, cover = self.judge(part)
        return ("", 0.0) if cut == "colon" and kind != "rendering" or kind and self.against(list(whole)) >= MIN_COVERAGE else (kind, cover)

    def covered(self, ids: list[int]) -> tuple[dict[int, float], dict[int, float]]:
        """By exemplar with a word in the window: the weight of the exemplar's words that the window holds, and the share of the window it covers."""
        ex, w = self.ex, self.weight
        whole, found = sum(w[i] for i in ids), {}
        for i in set(ids):
            if i < len(ex.vocabulary):
                for e in ex.holding[i]:
                    found[e] = found.get(e, 0.0) + w[i]
        return found, {e: sum(w[i] for i in ids if i in own) / whole for e, own in ((e, set(ex.ids[e])) for e in found)}

    def against(self, ids: list[int], by: tuple[dict[int, float], dict[int, float]] | None = None) -> float:
        """The share of a window that a counterexample covers."""
        found, covered = by or self.covered(ids)
        return max((c for e, c in covered.items() if self.ex.kind[e] == "content" and found[e] >= MIN_CONTAINED * self.mass[e]), default=0.0)

    def best(self, ids: list[int]) -> tuple[str, float]:
        """(kind, coverage) of the exemplar that covers a window best; kind is '' if none does well enough."""
        ex, w = self.ex, self.weight
        whole, held = sum(w[i] for i in ids), set(ids)
        found, covered = self.covered(ids)
        against = self.against(ids, (found, covered))
        best = ("", 0.0)
        for e in sorted(found):
            kind, cover = ex.kind[e], covered[e]
            if kind == "content" or cover < against:
                continue
            if kind == "slot":
                ok = against < MIN_COVERAGE
            elif kind == "loose":
                ok = cover >= MIN_COVERAGE and len(ids) >= MIN_LOOSE
            else:
                ok = cover >= MIN_COVERAGE and found[e] >= MIN_CONTAINED * self.mass[e]
            if ok and cover > best[1]:
                best = (kind, cover)
        if not best[0] and ex.slot in held and against < MIN_COVERAGE:
            best = ("slot", w[ex.slot] / whole)
        return best if best[0] or against >= MIN_COVERAGE else self.together(ids, found)

    def together(self, ids: list[int], found: dict[int, float]) -> tuple[str, float]:
        """(kind, coverage) of a window that several exemplars of one kind cover: a wording between theirs. Words must also stand in pairs as they do in them."""
        ex, w = self.ex, self.weight
        whole, held = sum(w[i] for i in ids), set(ids)
        ordered = set(zip(ids, ids[1:], strict=False))
        least = MIN_PART if len(held) > 1 else MIN_ONE
        best = ("", 0.0)
        for kind in ("error", "script", "filler", "rendering"):
            parts = [e for e in found if ex.kind[e] == kind and found[e] >= least * self.mass[e]]
            got: set[int] = set()
            paired: set[tuple[int, int]] = set()
            for _ in range(MOST_PARTS):  # the one that adds most
                e = max(parts, key=lambda e: (sum(w[i] for i in held.intersection(ex.ids[e]) - got), -e), default=None)
                if e is None or held.intersection(ex.ids[e]) <= got:
                    break
                got |= held.intersection(ex.ids[e])
                paired |= ex.pairs[e] & ordered
            if not got:
                continue
            cover, rarest = sum(w[i] for i in ids if i in got) / whole, sorted((w[i] for i in got), reverse=True)[:2]
            if cover >= MIN_UNION and sum(rarest) >= MIN_RARITY * len(rarest) * w[-1] and (paired or cover >= MIN_ALONE) and cover > best[1]:
                best = (kind, cover)
        return best


def residue_windows(records: DataFrame, exemplars: Pairs = DEFAULT) -> DataFrame:
    """(src, rec_id, kind, coverage) of every residue window of (src, rec_id, text) or (src, rec_id, text, title), where text begins with the title."""
    windows = _grouped_windows(records, exemplars)
    counts = {r[0]: r[1] for r in windows.where("word is not null").groupBy("word").agg(F.sum("n")).collect()}  # at most the vocabulary's size
    df, n = np.array([counts.get(k, 0) for k in range(len(Exemplars(exemplars).vocabulary))], np.float64), int(counts.get(-1, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(df, n, Exemplars(exemplars))
        cache: dict[tuple, tuple[str, float]] = {}
        for b in batches:
            values, offsets, cuts, wholes = b.column(2).flatten().to_numpy().tolist(), b.column(2).offsets.to_numpy().tolist(), b.column(3).to_pylist(), b.column(4)
            rows, kinds, covers = [], [], []
            for i in range(b.num_rows):
                window = tuple(values[offsets[i] - offsets[0] : offsets[i + 1] - offsets[0]])
                key = window if cuts[i] is None else (window, cuts[i], tuple(wholes[i].as_py()))
                if key not in cache:
                    if len(cache) > 200_000:
                        cache.clear()
                    cache[key] = scorer.judge(window) if cuts[i] is None else scorer.judge_part(*key)
                kind, cover = cache[key]
                if kind:
                    rows.append(i)
                    kinds.append(kind)
                    covers.append(float(cover))
            at = pa.array(rows, pa.int64())
            recs = b.column(1).take(at)
            of = pc.list_parent_indices(recs)
            yield pa.RecordBatch.from_pydict({"src": b.column(0).take(at).take(of), "rec_id": recs.flatten(), "kind": pa.array(kinds, pa.string()).take(of), "coverage": pa.array(covers, pa.float64()).take(of)})

    return windows.where("word is null").select("src", "recs", "window", "cut", "whole").mapInArrow(run, "src string, rec_id bigint, kind string, coverage double")


def exemplar_pairs(df: DataFrame, most: int = 5_000) -> Pairs:
    """A table (kind, text) of labelled exemplars as pairs; kinds are those of EXEMPLARS, and 'content' for counterexamples. More than `most` are an error."""
    rows = df.where("kind is not null and text is not null").select("kind", "text").distinct().orderBy("kind", "text").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} exemplars")
    return tuple((r[0], r[1]) for r in rows)


def record_texts(df: DataFrame, src: str, key: str, title: str = "title", body: str = "body_text") -> DataFrame:
    """(src, rec_id, text, title): the title, a break, and the body of each record; and the title."""
    return df.select(F.lit(src).alias("src"), F.col(key).cast("bigint").alias("rec_id"), F.concat_ws("\n", F.col(title), F.col(body)).alias("text"), F.col(title).alias("title"))


def residue_records(records: DataFrame, exemplars: Pairs = DEFAULT) -> DataFrame:
    """(src, rec_id) of the records that hold residue; records is (src, rec_id, text) or (src, rec_id, text, title)."""
    return residue_windows(records, exemplars).select("src", "rec_id").dropDuplicates()


def without_residue(df: DataFrame, src: str, key: str, found: DataFrame) -> DataFrame:
    """df without the found records."""
    return df.join(found.where(F.col("src") == src).select(F.col("rec_id").alias(key)), key, "left_anti")
