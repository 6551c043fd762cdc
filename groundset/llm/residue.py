"""Problem 10: template residue, filler, error pages and script notices.

Character n-gram models are fitted for unfilled placeholders, filler, notices and natural
prose: seed models from forms of general use and the prose of all whole texts, then models of
all texts the seeds are sure of. The log ratio of each residue model to prose is summed over
windows of a text; windows above a threshold localise residue. Filler and notices count by what
the windows cover, a placeholder by one window that an exact grammar of placeholders confirms.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundset.session import table

ORDER = 4
BITS = 20
PIECE = 1 << 16  # signs worked on at a time, so that arrays stay in the cache
WINDOWS = (12, 24, 24)  # in signs, for each kind
WINDOW = max(WINDOWS)
KINDS = ("placeholder", "filler", "notice")
SCALE = 16.0
SHARE = 0.2
BLANK = 28  # the class of blanks in the alphabet
BIAS, FIELD, TOP = 128, 16, 1 << 15  # of packed log ratios
CONFIDENT = 0.6  # of a text's signs, for what the seed models find to be learned from as residue
LEARNED_THRESHOLDS = (0.0, 0.4, 0.4)  # mean log ratio of a window, for each kind; models of all texts know the corpus, so they need less than the seeds
DOUBT = 0.05  # of a text's signs, below which it is learned from as prose
#: Reason phrases of the HTTP status codes.
STATUS = {400: "Bad Request", 401: "Unauthorized", 403: "Forbidden", 404: "Not Found", 405: "Method Not Allowed", 408: "Request Timeout", 410: "Gone", 429: "Too Many Requests", 500: "Internal Server Error", 502: "Bad Gateway", 503: "Service Unavailable", 504: "Gateway Timeout"}
#: Forms of notices, by family. A form is written out by taking one way of each bracket of choices.
NOTICE_FORMS = {
    "status": ["{HTTP |Error |Status |}{STATUS}{. The server returned this status.|: please try again later.|}", "<html><head><title>{STATUS}</title></head><body><h1>{STATUS}</h1><hr>{nginx|Apache|server}</body></html>", "Fehler {CODE}: {der Dienst|der Server} {ist nicht erreichbar|meldet einen Fehler}.", "Erreur {CODE} : {le serveur|le service} {est indisponible|a rencontré un problème}.", "Fel {CODE}: {servern|tjänsten} {är inte tillgänglig|kan inte nås}."],
    "missing": [
        "{The|That} {page|file|document|address|resource|link} {you asked for|you are looking for|you followed|requested} {could not be found|does not exist|is not here any more|has been moved, renamed or deleted}. {Please check the URL.|Go back to the home page.|}", "{Oops!|Sorry,|} {we can't find that page|nothing was found at this address}.",
        "Die {gewünschte|gesuchte|aufgerufene} {Seite|Datei|Adresse} {wurde nicht gefunden|existiert nicht|ist nicht verfügbar}. {Zurück zur Startseite.|Überprüfen Sie die URL.|}", "{La page|Le fichier|L'adresse} {demandée|recherchée} {n'existe pas|est introuvable|n'a pas été trouvée}. {Retour à l'accueil.|Vérifiez l'URL.|}", "{Sidan|Filen|Adressen} {du söker|som begärdes} {finns inte|hittades inte|har flyttats}. {Gå till startsidan.|Kontrollera adressen.|}",
    ],
    "failure": [
        "{An error occurred|Something went wrong|An unexpected problem occurred} while {loading|processing|opening} {this page|your request|the file}. {Please try again later.|Reload the page.|Contact support.}", "{The server|The service|This site|The database} is {temporarily unavailable|down for maintenance|overloaded|not responding}. {Please try again in a few minutes.|}", "The {connection|request} {timed out|was reset|was refused}.",
        "{Fatal error|Warning|Notice|Exception}: {undefined variable|call to undefined method|null pointer|connection refused} in {/var/www/html/index.php|/app/main.py|/usr/lib/handler.rb} on line {NUM}", 'Traceback (most recent call last): File "/app/main.py", line {NUM}, in {handler|main} {ValueError|TypeError|IOError}: {bad request|timeout}', '{{"error": {NUM}, "message": "{internal error|not found|timeout}"}}',
        "{Der Server|Der Dienst|Die Datenbank} {ist vorübergehend nicht erreichbar|antwortet nicht|wird gewartet}. {Bitte versuchen Sie es später erneut.|}", "{Le serveur|Le service|Le site} {est temporairement indisponible|ne répond pas|est en maintenance}. {Veuillez réessayer plus tard.|}", "{Servern|Tjänsten|Webbplatsen} {svarar inte|är tillfälligt nere|underhålls}. {Försök igen senare.|}", "Ein Fehler ist aufgetreten. Une erreur est survenue. Ett fel har uppstått.",
    ],
    "access": [
        "{Access|Permission} denied. {You are not authorized to|You do not have the rights to|You are not allowed to} {view|access|open} this {page|file|resource|item}.", "Your {session|login|link} {has expired|has timed out|is no longer valid}. {Please log in again.|Sign in to continue.|}", "{Too many|You have made too many} requests. {Please slow down.|Try again later.|Rate limit reached.}",
        "Zugriff {verweigert|nicht gestattet}. {Sie haben keine Berechtigung für diese Seite.|Bitte anmelden.}", "Ihre {Sitzung|Anmeldung} ist {abgelaufen|ungültig}. {Bitte erneut anmelden.|}", "Accès {refusé|interdit}. {Vous n'avez pas l'autorisation d'ouvrir cette page.|Connectez-vous.}", "Votre session {a expiré|n'est plus valide}. {Veuillez vous reconnecter.|}", "{Åtkomst|Tillgång} {nekad|saknas}. {Du har inte behörighet till sidan.|Logga in igen.}",
    ],
    "scripts": [
        "{Please|You need to|You must|} {enable|turn on|activate|allow} {JavaScript|scripts|scripting|JavaScript and cookies} {in your browser|in the settings|} to {view|use|load|open|see} this {site|page|app|content}.", "JavaScript is {disabled|required|not enabled|turned off|blocked}{ in your browser|}. {This page cannot be displayed.|Enable it and reload.|}", "{This|Our} {site|page|app|application|service} {needs|requires|does not work without|relies on} {JavaScript|scripts|cookies and scripts}.", "<noscript>{You need to enable JavaScript to run this app.|JavaScript is required.}</noscript>",
        "{Your browser|This browser} {does not support|is blocking|has disabled} {scripts|JavaScript|active content}. {Update your browser.|Turn them on and refresh the page.|}", "{Checking|Verifying} {your browser|that you are human|your connection} before {you continue|access|the page loads}. {Enable cookies and JavaScript.|This may take a few seconds.}",
        "{Bitte|} {aktivieren|erlauben|schalten} Sie {JavaScript|Skripte} {in Ihrem Browser|}{ ein|}, um diese {Seite|Anwendung} {anzuzeigen|zu nutzen|zu laden}.", "{Diese Seite|Diese Anwendung} {funktioniert nicht ohne|erfordert|braucht} {JavaScript|Skripte}.", "JavaScript ist {deaktiviert|ausgeschaltet|erforderlich}.",
        "{Veuillez|Merci d'|} {activer|autoriser} {JavaScript|les scripts} {dans votre navigateur|} pour {afficher|utiliser|voir} {cette page|ce site|l'application}.", "{Cette page|Ce site} {nécessite|exige|ne fonctionne pas sans} {JavaScript|scripts}.", "JavaScript est {désactivé|requis|bloqué}.",
        "{Aktivera|Tillåt|Slå på} {JavaScript|skript} {i webbläsaren|} för att {visa|använda|se} {sidan|webbplatsen|innehållet}.", "{Sidan|Webbplatsen} {kräver|fungerar inte utan|behöver} {JavaScript|skript}.", "JavaScript är {avstängt|inaktiverat|blockerat}.",
    ],
    "frame": ["{Home|Start} | {About|Products|News} | {Help|Contact|Login}. {Menu|Navigation}. {Search|Sign in|Log in|Register}. {Terms of use|Privacy policy|Cookie policy|Imprint}. {Report a problem|Contact us|Back to top}.", "{Request|Reference|Incident|Trace} ID: {HEX}", "{Loading|Please wait|Redirecting}... {If nothing happens, reload the page.|If you are not redirected, click here.}"],
}
#: Forms of sentences that stand for a text to come.
FILLER_FORMS = {
    "later": ["{Text|Content|Description|Summary|Details} {to follow|coming soon|to be added|will follow|goes here|to be written}.", "{Coming soon|To be announced|Under construction}: {page|item|section|entry} {NUM}.", "{Text|Inhalt|Beschreibung} {folgt|folgt später|wird ergänzt|kommt bald}.", "{Texte|Contenu|Description|Résumé} {à venir|à compléter|à ajouter|bientôt disponible}.", "{Text|Innehåll|Beskrivning} {kommer|kommer snart|kommer senare|läggs till}.", "No {description|text|content|notes} {yet|available yet}."],
    "here": ["{Your|Insert|Add|Enter|Type|Put} {text|content|title|description|paragraph} here{ (NUM)|}.", "{Here is|This is} {where|the place where} {your|the} {text|description|summary} {goes|will stand}.", "{Hier|An dieser Stelle} {steht|kommt|folgt} {Ihr Text|der Text|die Beschreibung}{ von Eintrag {NUM}|}.", "{Ici|À cet endroit} {votre texte|le texte|la description}{ de la notice {NUM}|}.", "{Här} {kommer|står|skriver du} {texten|din text|beskrivningen}{ av post {NUM}|}.", "{Ihr|Dein} Text hier. Votre texte ici. Din text här."],
    "replace": ["{Replace|Change|Edit|Rewrite} this {text|paragraph|sentence|placeholder} {with your own|with the description of item {NUM}|before publishing}.", "{Ersetzen Sie|Ersetze|Bitte ersetzen} {diesen Absatz|diesen Text}{ durch die Beschreibung|}.", "{Remplacez|Modifiez} {ce paragraphe|ce texte} par {la description|votre texte}.", "{Ersätt|Byt ut} {detta stycke|den här texten} med {beskrivningen|din text}."],
    "dummy": ["{This is|} {placeholder|sample|dummy|example|filler} text{ for {page|item|section} {NUM}|}.", "{Platzhalter|Blindtext|Mustertext|Beispieltext}{ für {Seite|Eintrag} {NUM}|}. {Blindtext Blindtext.|}", "{Texte|Paragraphe} {d'exemple|de remplissage|provisoire}{ pour {la page|la notice} {NUM}|}.", "{Exempeltext|Platshållare|Utfyllnadstext}{ för {sida|post} {NUM}|}. {exempeltext exempeltext.|}"],
    "todo": ["TODO: {write|add|fill in|complete} {the description|this section|the text} of {item|page} {NUM}.", "[{No|Missing} {summary|description|text} yet]"],
}
#: The words of filler that imitates Latin.
LATIN = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
#: Parts of the names of fields, and the signs that open and close a placeholder in template languages.
PARTS = "name first last full user customer company order item page page_number title sub heading date time year month day id code email address city country phone price total count link url image text body content description summary note comment author owner place source category label value field key".split()
OPEN_CLOSE = (("{{", "}}"), ("{{ ", " }}"), ("{{#if ", "}}"), ("${", "}"), ("#{", "}"), ("{", "}"), ("{% ", " %}"), ("<%= ", " %>"), ("<% ", " %>"), ("<!-- ", " -->"), ("%%", "%%"), ("@@", "@@"), ("__", "__"), ("$", "$"), ("[[", "]]"), ("%(", ")s"), ("<your ", " here>"), ("<insert-", ">"), ("<enter ", ">"), ("[INSERT ", " HERE]"), ("[Your ", "]"), ("[enter ", "]"), ("[add ", "]"))
BARE = ("TBD", "TODO", "XXXX", "XX/XX/XXXX", "{0}", "{1}", "FIXME")
_CHOICE = re.compile(r"\{([^{}]*)\}")
_W = r"[A-Za-z_][\w.\-]*"
#: The grammar of placeholders. One letter in braces is a sign, not a field; editorial marks have no such form.
PLACEHOLDER = re.compile(
    rf"\{{\{{[#/]?\s*[\w .#]+?\s*\}}\}}|[$#]\{{\s*{_W}\s*\}}?|\{{%-?\s*[\w .]+?\s*-?%\}}|<%=?\s*[\w .]+?\s*%>|<!--\s*[\w .$]+?\s*-->|%%{_W}%%|@@{_W}@@|(?<!\w)__[A-Za-z][\w.]*?__(?!\w)|(?<![\w$])\$[A-Za-z][\w.]*\$"
    rf"|\[\[\s*{_W}\s*\]\]|%\({_W}\)[sd]|<(?:your|insert|enter)[ \-][\w.\- ]+?>|\[(?:insert|your|enter|add|type|fill)\b[^\]\n]{{1,40}}\]|\{{(?:\d{{1,2}}|[A-Za-z_][\w.]+)\}}|\{{\{{|\{{%\s|<%=|\$\{{"
    r"|(?<!\w)(?:TBD|TODO|FIXME|XXXX+)(?!\w)|\bXX/XX/XX|\[No [a-z]+ yet\]",
    re.I,
)


@lru_cache(maxsize=1)
def alphabet() -> np.ndarray:
    """Code point -> class of 0..63: letters without case and accent, one digit, one blank, each usual sign."""
    import unicodedata

    out = np.full(0x10000, 63, np.uint32)
    signs = ".,:;!?'\"()[]{}<>/|%$#@_-=&*~"
    for n in range(0x3000):
        ch = unicodedata.normalize("NFD", chr(n).lower())[:1]
        if "a" <= ch <= "z":
            out[n] = 1 + ord(ch) - 97
        elif ch.isdigit():
            out[n] = 27
        elif chr(n).isspace():
            out[n] = 28
        elif ch in signs:
            out[n] = 29 + signs.index(ch)
        elif ch.isalpha():
            out[n] = 62
    return out


def grams(codes: np.ndarray) -> np.ndarray:
    """The bucket of the n-gram that starts at each code; the last ones reach over the end."""
    out = np.empty(len(codes), np.int64)
    for a in range(0, len(codes), PIECE):
        c = alphabet().take(codes[a : a + PIECE + ORDER - 1], mode="clip")
        n = min(PIECE, len(codes) - a)
        c = np.concatenate([c, np.full(n + ORDER - 1 - len(c), BLANK, np.uint32)])
        h = c[:n].copy()
        for k in range(1, ORDER):
            h *= np.uint32(64)
            h += c[k : k + n]
        h *= np.uint32(2654435761)
        h >>= np.uint32(32 - BITS)
        out[a : a + n] = h
    return out


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _counts(texts: list[str]) -> np.ndarray:
    """How often each n-gram stands in the texts; some millions of signs at a time, a longer text alone."""
    out = np.zeros(1 << BITS, np.float64)
    group, size = [], 0
    for t in [*texts, None]:
        if group and (t is None or size + len(t) > 1 << 22):
            out += np.bincount(grams(points("\n".join(group))), minlength=1 << BITS)
            group, size = [], 0
        if t is not None:
            group.append(t)
            size += len(t)
    return out


def _groups(texts: list[str | None]) -> Iterator[list[str]]:
    """The texts in groups of some million signs, so that the arrays stay small; a longer text is a group of its own."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or "") <= 1 << 20):
            size += len(texts[j] or "")
            j += 1
        yield [t or "" for t in texts[i:j]]
        i = j


def _inside(texts: list[str]) -> np.ndarray:
    """The n-grams inside texts, none of which reaches over an end."""
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = points("".join(texts))
    ends = np.cumsum(lengths)
    whole = np.ones(len(codes), bool)
    for k in range(1, ORDER):
        whole[ends[lengths >= k] - k] = False
    return grams(codes)[whole]


def written_out(form: str, rng: random.Random) -> str:
    """A form with one way taken of each bracket of choices, innermost first."""
    out = form.replace("{{", "\x01").replace("}}", "\x02")
    while (m := _CHOICE.search(out)) is not None:
        one = rng.choice(m[1].split("|"))
        code = rng.choice(list(STATUS))
        one = {"STATUS": f"{code} {STATUS[code]}", "CODE": str(code), "NUM": str(rng.randint(1, 400)), "HEX": f"{rng.getrandbits(32):08x}"}.get(one, one)
        out = out[: m.start()] + one + out[m.end() :]
    return out.replace("\x01", "{").replace("\x02", "}").replace("(NUM)", f"({rng.randint(1, 99)})").strip()


def training_residue(seed: int = 5, without: str | None = None, each: int = 40) -> dict[str, list[str]]:
    """Texts of each residue kind, written out from the forms by a seeded rule; one family of forms may be left out."""
    rng = random.Random(seed)
    latin = [" ".join(rng.choice(LATIN) for _ in range(14)).capitalize() + "." for _ in range(400)]

    def field() -> str:
        name = rng.choice(("_", ".", "", " ", "_")).join(rng.sample(PARTS, rng.choice((1, 1, 2))))
        return rng.choice((str.lower, str.lower, str.upper, str.capitalize))(name)

    marks = [a + field() + b for a, b in OPEN_CLOSE for _ in range(60)] + list(BARE) * 20
    rng.shuffle(marks)
    of = lambda forms: [written_out(f, rng) for family, fs in forms.items() if family != without for f in fs for _ in range(each)]
    return {"placeholder": marks, "filler": latin + of(FILLER_FORMS), "notice": of(NOTICE_FORMS)}


class Residue:
    """The fitted models as one table of scaled log ratios for each kind."""

    def __init__(self, tables: np.ndarray, thresholds: tuple[float, ...] = (0.0, 1.1, 0.9)) -> None:
        self.tables, self.thresholds = tables, thresholds

    @classmethod
    def of_counts(cls, residue: dict[str, list[np.ndarray]], base: np.ndarray, eps: float = 2e-6) -> Residue:
        """From n-gram counts: of each kind the counts of its sources, which weigh the same, and those of prose."""
        share = lambda n: n / max(1.0, n.sum())
        ratio = []
        for k in KINDS:
            sources = [n for n in residue[k] if n.sum() > 0]
            p = sum(map(share, sources)) / max(1, len(sources)) if sources else np.zeros_like(base)
            r = np.log((p + eps) / (share(base) + eps))
            r[(p == 0) & (base == 0)] = 0.0
            ratio.append(np.clip(np.rint(r * SCALE), -127, 127).astype(np.int8))
        return cls(np.stack(ratio))

    @classmethod
    def seeded(cls, prose: Callable[[Residue | None], np.ndarray], rounds: int = 2, without: str | None = None) -> Residue:
        """The seed models: residue from the forms, prose from the counts of all texts; what the first models call residue is left out of prose in the next round.

        ``prose`` gives the counts of the texts that a model calls no residue, of all texts where there is no model yet.
        """
        made = {k: [_counts(v)] for k, v in training_residue(without=without).items()}
        model = None
        for _ in range(rounds):
            model = cls.of_counts(made, prose(model))
        assert model is not None
        return model

    @classmethod
    def fit(cls, prose: list[str], rounds: int = 2, without: str | None = None) -> Residue:
        """The seed models of texts in memory."""
        return cls.seeded(lambda model: _counts(prose if model is None else [t for t, kind in zip(prose, model.kinds(prose)[0]) if kind is None]), rounds, without)

    @cached_property
    def packed(self) -> np.ndarray:
        """The log ratios of an n-gram for all kinds as one number of 16 bits for each kind, moved by BIAS so that sums over a window neither carry nor borrow."""
        return sum((self.tables[k].astype(np.int64) + BIAS) << FIELD * k for k in range(len(KINDS)))

    def _limits(self) -> dict[int, tuple[np.ndarray, int]]:
        """For each width of a window, by the signs in it: what must be added to its packed sum that the top bit of a field says if the sum is above the threshold; and these bits."""
        out = {}
        for width in WINDOWS:
            mine = [k for k in range(len(KINDS)) if WINDOWS[k] == width]
            most = lambda k, n: min(max(math.floor(self.thresholds[k] * SCALE * n) + BIAS * n, 0), TOP - 1)
            out[width] = np.array([sum(TOP - 1 - most(k, n) << FIELD * k for k in mine) for n in range(width + 1)], np.int64), sum(TOP << FIELD * k for k in mine)
        return out

    def kinds(self, texts: list[str | None], sink: Callable[[np.ndarray, np.ndarray, np.ndarray, list, list], None] | None = None) -> tuple[list[str | None], list[float]]:
        """The kind of residue of each text (None for real content) and the share of its signs that residue windows cover.

        ``sink`` gets, some million signs at a time, the n-grams, where in them each text starts and ends, and kinds and shares of these texts.
        """
        kinds: list[str | None] = []
        shares: list[float] = []
        for group in _groups(texts):
            a, b = self._group(group, sink)
            kinds += a
            shares += b
        return kinds, shares

    def _group(self, texts: list[str], sink: Callable[[np.ndarray, np.ndarray, np.ndarray, list, list], None] | None) -> tuple[list[str | None], list[float]]:
        lengths = np.array([len(t) for t in texts], np.int64)
        codes = points("".join(texts))
        kinds: list[str | None] = [None] * len(texts)
        shares = [0.0] * len(texts)
        if not len(codes):
            return kinds, shares
        ends = np.cumsum(lengths)
        starts = ends - lengths
        h = grams(codes)
        limits = self._limits()
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
            self._piece(texts, codes, h, starts, ends, i, j, limits, kinds, shares)
            i = j
        if sink is not None:
            sink(h, starts, ends, kinds, shares)
        return kinds, shares

    def _hits(self, h: np.ndarray, starts: np.ndarray, ends: np.ndarray, limits: dict[int, tuple[np.ndarray, int]]) -> list[np.ndarray]:
        """For each kind the signs whose window is above the threshold; h are the n-grams of texts that follow one another."""
        n = len(h)
        total = np.zeros(n + 1, np.int64)
        np.cumsum(self.packed[h], out=total[1:])  # may overflow; differences are right all the same
        out = [np.empty(0, np.int64)] * len(KINDS)
        for width, (added, tops) in limits.items():
            half = width // 2
            above = np.zeros(n, np.int64)
            if n >= width:
                inner = above[half : n - half + 1]
                np.subtract(total[width:], total[:-width], out=inner)
                inner += added[width]
                inner &= tops
            for first, step in ((starts, 1), (ends - 1, -1)):  # windows that the ends of a text cut off
                at = first[:, None] + step * np.arange(half)
                inside = (at >= starts[:, None]) & (at < ends[:, None])
                lo, hi = np.maximum(at - half, starts[:, None])[inside], np.minimum(at + half, ends[:, None])[inside]
                above[at[inside]] = (total[hi] - total[lo] + added[hi - lo]) & tops
            at = np.flatnonzero(above != 0)
            for k in range(len(KINDS)):
                if WINDOWS[k] == width:
                    out[k] = at[(above[at] & (TOP << FIELD * k)) != 0]
        return out

    def _piece(self, texts: list[str], codes: np.ndarray, h: np.ndarray, starts: np.ndarray, ends: np.ndarray, i: int, j: int, limits: dict[int, tuple[np.ndarray, int]], kinds: list[str | None], shares: list[float]) -> None:
        """Judge the texts i to j."""
        a, b = int(starts[i]), int(ends[j - 1])
        placeholder, filler, notice = (a + at for at in self._hits(h[a:b], starts[i:j] - a, ends[i:j] - a, limits))
        if not (len(placeholder) or len(filler) or len(notice)):
            return
        either = np.union1d(filler, notice)

        def covered(at: np.ndarray) -> np.ndarray:
            ink = at[alphabet().take(codes[at], mode="clip") != BLANK]
            return np.bincount(np.searchsorted(ends[i:j], ink, "right"), minlength=j - i)

        of_placeholder, of_filler, of_either = covered(placeholder), covered(filler), covered(either)
        for m in np.flatnonzero((of_placeholder > 0) | (of_either > 0)):
            t = i + int(m)
            ink = max(1.0, float(np.count_nonzero(alphabet().take(codes[starts[t] : ends[t]], mode="clip") != BLANK)))
            share = of_either[m] / ink
            shares[t] = round(float(share), 4)
            where = placeholder[slice(*np.searchsorted(placeholder, (starts[t], ends[t])))] - starts[t]
            if len(where) and self._confirmed(texts[t], where):
                kinds[t] = "placeholder"
            elif of_filler[m] >= 60 or of_filler[m] >= SHARE * ink:
                kinds[t] = "filler"
            elif share >= SHARE:
                kinds[t] = "notice"

    @staticmethod
    def _confirmed(text: str, where: np.ndarray) -> bool:
        """A placeholder by the grammar, in or next to a window."""
        cut = np.flatnonzero(np.diff(where) > 2 * WINDOW) + 1
        for part in np.split(where, cut):
            if PLACEHOLDER.search(text, max(0, int(part[0]) - WINDOW), int(part[-1]) + WINDOW):
                return True
        return False


def corpus_counts(docs: DataFrame, text: str, rules: Sequence[Callable[[str | None, float], bool]], model: Residue | None = None) -> np.ndarray:
    """The n-grams inside the whole texts of the corpus, counted in a row for each rule: of the texts whose kind and share by the model it takes.

    Without a model all texts count in every row. What is sent to the driver are at most 2^BITS counts of each row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.tables) if model else None  # 3 MB, whatever the data
    thresholds = model.thresholds if model else ()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Residue(shared.value, thresholds) if shared else None
        total = np.zeros((len(rules), 1 << BITS), np.int64)
        taken: list[list[np.ndarray]] = [[] for _ in rules]  # not yet counted

        def count(h: np.ndarray, starts: np.ndarray, ends: np.ndarray, kinds: list, shares: list) -> None:
            for row, rule in enumerate(rules):
                taken[row] += [h[a : b - ORDER + 1].copy() for a, b, k, s in zip(starts, ends, kinds, shares) if b - a >= ORDER and rule(k, s)]
                if sum(map(len, taken[row])) > 1 << 20:
                    add(row)

        def add(row: int) -> None:
            if taken[row]:
                total[row] += np.bincount(np.concatenate(taken[row]), minlength=1 << BITS)
                taken[row].clear()

        for b in batches:
            texts = [t for t in b.column(0).to_pylist() if t]
            if own:
                own.kinds(texts, count)
            else:
                for group in _groups(texts):
                    total += np.bincount(_inside(group), minlength=1 << BITS)
        for row in range(len(rules)):
            add(row)
            at = np.flatnonzero(total[row])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row, np.int32)), pa.array(at.astype(np.int32)), pa.array(total[row][at])], ["row", "gram", "n"])

    counted = docs.select(text).mapInArrow(run, "row int, gram int, n long").groupBy("row", "gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((len(rules), 1 << BITS), np.float64)
    out[counted["row"].to_numpy(), counted["gram"].to_numpy()] = counted["n"].to_numpy()
    return out


def learned(docs: DataFrame, key: str, text: str) -> Residue:
    """Models of all texts: the seed models, whose prose is that of all whole texts, sort every whole text, and the n-grams of what they are sure of are counted over the corpus.

    Texts they cover to CONFIDENT or more are residue to learn from, those they cover to less
    than DOUBT are prose. No text is drawn or cut, so the key isn't needed. All n-grams are
    counted once; those of prose are all less those of the few texts that aren't prose.
    """
    every = corpus_counts(docs, text, [lambda kind, share: True])[0]
    seed = Residue.seeded(lambda model: every if model is None else every - corpus_counts(docs, text, [lambda kind, share: kind is not None], model)[0])
    other, filler, notice = corpus_counts(docs, text, [
        lambda kind, share: kind is not None or share >= DOUBT,
        lambda kind, share: kind == "filler" and share >= CONFIDENT,
        lambda kind, share: kind == "notice" and share >= CONFIDENT,
    ], seed)
    prose = every - other
    made = {k: [_counts(v)] for k, v in training_residue().items()}
    made["filler"].append(filler)
    made["notice"].append(notice)
    model = Residue.of_counts(made, prose)
    model.thresholds = LEARNED_THRESHOLDS
    return model


def flag_residue(docs: DataFrame, key: str, text: str, model: Residue | None = None) -> DataFrame:
    """All columns but the text, with ``residue`` (the kind or null) and ``residue_share``.

    Null and empty texts are no residue. Whole texts are scored; unless a model is given,
    one is learned from all texts.
    """
    model = model or learned(docs, key, text)
    keep = [c for c in docs.columns if c not in (text, "residue", "residue_share")]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("residue", T.StringType()), T.StructField("residue_share", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model.tables)  # 3 MB, whatever the data
    thresholds = model.thresholds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Residue(shared.value, thresholds)
        for b in batches:
            kinds, shares = own.kinds(b.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(kinds, pa.string()), pa.array(shares, pa.float64())], [*keep, "residue", "residue_share"])

    return docs.select(*keep, text).mapInArrow(run, schema)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return flag_residue(docs, "doc_id", "text").where("residue IS NOT NULL").select("doc_id").distinct()


def p10_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that stay."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    return flag_residue(docs, "doc_id", "text").where("residue IS NULL").select("doc_id", "lang", "source", "n_chars")


def p10_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by kind of residue ('' for real content)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return flag_residue(docs, "doc_id", "text").groupBy(F.coalesce("residue", F.lit("")).alias("residue")).agg(F.count("*").alias("documents"))


QUERIES = {"p10_found": p10_found, "p10_clean": p10_clean, "p10_report": p10_report}
