"""Problem 10: template residue and error-page text.

`placeholder`: a slot that a program should have filled stands in running text. Each delimiter has its grammar
({{name}}, ${name}, <%= name %>, {name}, [INSERT NAME HERE], <your name>, %NAME%, %(name)s, __NAME__, #NAME#, «NAME»,
XXXXX, TODO: ..., [object Object]); code blocks and inline code are taken out first, and so are the sentences that speak
of code, unless the slots of the text are as dense as only an unfilled template has them. Sets of numbers, bracketed
words and comparisons ("<5 kg") fit no grammar.

`filler`, `error_page`, `script_notice`: the content is nothing but that. Posed questions, role labels and page chrome
are set aside, the rest is cut into sentences, each sentence is told as one of the kinds or as other text, and the kind
holds only where next to no words of other text remain. A real text with a sentence about JavaScript or 404 keeps its
other words and is no case.

One Arrow pass brings special characters to their plain form and tells which texts hold a sign of contentless text or of a
slot; the grammars and the cutting into sentences are Column expressions (JVM) that run on those texts alone. Null and empty texts have no kind; repeated rows come out as
often as they stand; a clashing column named `kind` is replaced in the result.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from millrace.llm.forms import form

_NAME = r"[A-Za-z_][A-Za-z0-9_]*(?:\.[A-Za-z_][A-Za-z0-9_]*)*"
_UPPER = r"[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)*"
#: The grammar of a slot for each kind of delimiter
SLOTS = {
    "mustache": rf"\{{\{{[#/&]?\s*{_NAME}\s*\}}\}}",
    "shell": rf"\$\{{\s*{_NAME}\s*\}}",
    "server page": rf"<%[=-]?\s*{_NAME}\s*-?%>",
    "brace": rf"(?<![\\\w}}{{$])\{{{_NAME}\}}(?!\}})",
    "instruction": r"\[(?i:(?:please )?(?:insert|enter|your|add|fill in|shyiramo|andika|votre|vos|insérez|inscrire|weka|jaza|andikia)\s[^\[\]\n]+)\]",
    "capital brackets": rf"\[{_UPPER}(?: {_UPPER}){{0,4}}\](?!\()",
    "angle": r"<(?i:your|votre|insert|enter|weka|shyiramo)\s[^<>\n]+>",
    "percent": rf"%{_UPPER}%|%\({_NAME}\)[sd]",
    "underscore": rf"(?<!\w)__{_UPPER}__(?!\w)",
    "hash": rf"(?<!\w)#{_UPPER}#(?!\w)",
    "guillemets": rf"«{_UPPER}»",
    "crosses": r"(?<!\w)X{3,}(?!\w)",
    "to do": r"(?<!\w)TODO: ?\w",
    "object": r"\[object Object\]",
}
_SLOT = "|".join(SLOTS.values())
#: Code, and sentences that speak of code
_CODE = r"(?s)```.*?```|`[^`\n]*`"
_TUTORIAL = (
    r"(?i)(?<!\w)(?:template engine|templates?|variables?|shell|syntax|source code|code|kode|gabarits?|"
    r"placeholders?|regex|console|programming language|environment)(?!\w)"
)
#: So many slots in a text are a template, whatever it speaks of
DENSE_SLOTS = 3

_LOREM = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua "
    "enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat"
).split()
_KEYS = "asdf asdfg asdfgh asdfghjkl qwerty qwertz azerty jkl foo bar baz blah xxx test test1 test12 test123".split()
_DUMMY = rf"(?i)(?<!\w)(?:{'|'.join(dict.fromkeys(_LOREM + _KEYS))})(?!\w)"
KINDS = {
    "script_notice": (
        r"(?i)javascript|noscript|ecmascript|(?<!\w)scripts?(?!\w).{0,60}(?:enabled|switched on|turned on|only with|to run|needed|required|allow)"
        r"|scripting turned off|allow scripts|enable scripts|only with scripts"
        r"|ce site en a besoin|iwashe kisha|upakie upya|yifungure wongere|scripts?(?!\w).{0,30}(?:disabled|blocked|désactiv|zimezimwa)"
    ),
    "error_page": (
        r"(?i)not found|(?:erreur|error|hitilafu|kosa|ikosa)\W{0,3}\d{3}|^\W*\d{3}\W{1,4}(?:page|error|erreur|not|internal|bad|forbidden)"
        r"|bad (?:gateway|request)|gateway time-?out|access denied|permission denied|you do not have permission|permission to view"
        r"|temporarily unavailable|service unavailable|accès refusé|vous n'avez pas le droit|introuvable|page demandée"
        r"|ntirubonetse|ntiyabonetse|ntibonetse|subira ahabanza|haupatikani|haipatikani|habaye ikosa|ongera ugerageze nyuma"
        r"|server error|erreur (?:interne|du serveur)|internal error|http/\d|^\W*(?:content-type|connection|server|date|x-[a-z-]+|cache-control|location|status)\s*:"
        r"|traceback|^\s*file \"|(?<!\w)(?:key|value|type|index|name|attribute|runtime|import|syntax|timeout|connection)error(?!\w)|exception in|stack trace|^\s*at [\w.$]+\("
        r"|\"(?:error|code|status)\"\s*:|quota exceeded|too many requests|status(?: code)? \d{3}|<title>\s*\d{3}|does not exist|n'existe pas|haipo|forbidden|unauthorized"
        r"|session (?:has )?expired|log in again|could not connect|connection (?:refused|timed out|reset)|^\W*(?:fatal|warning|notice|uncaught|panic)\W.*(?:line \d+|failed|could not|undefined)"
        r"|tatizo la seva|wemerewe kureba|injira mbere|connexion au serveur|délai dépassé|could not complete your request|server could not|hairuhusiwi kuona|huna ruhusa|huruhusiwi"
        r"|segmentation fault|out of memory|null pointer|request timed out|something went wrong|une erreur|session a expiré|veuillez vous reconnecter"
        r"|try again (?:later|in)|réessayez|jaribu tena|umefutwa|moved or deleted|uburenganzira bwo kureba"
    ),
    "filler": (
        r"(?i)(?:text|content|copy) goes here|replace before publishing|placeholder (?:paragraph|text)|sample text|dummy text|texte à venir|contenu à venir|texte d'exemple"
        r"|hazajya umwandiko|umwandiko w'icyitegererezo|maandishi yatawekwa|maandishi ya mfano|coming soon|under construction|en construction|en cours de rédaction|revenez plus tard"
        r"|content to come|to be announced|irimo (?:gutegurwa|kubakwa)|inatengenezwa|inakuja hivi karibuni|biraza vuba|bientôt disponible|rudi baadaye|garuka nyuma"
    ),
}
_CHROME = (
    r"(?i)^\W*(?:menu|login|log in|sign in|search|home|about|contact|home +about +contact|©.*|copyright.*|.{1,40} - portal|[^|]{1,30}(?:\|[^|]{1,30})+|[^>]{1,30}(?:>[^>]{1,30})+"
    r"|shakisha|injira|ahabanza|mwanzo|tafuta|ingia|accueil|rechercher|connexion|skip to content|back to top|share|print)\W*$"
)
#: A posed question: its line, or its block up to the next heading
_POSED = (
    r"(?m)^(?:Ikibazo|Question|User|Swali|Q|Umukoresha)\s*:.*$|(?s)^#{1,4} ?(?:Instruction|Question|Ikibazo|Swali|Amabwiriza)[^\n]*\n.*?(?=\n#{1,4} ?\w)"
)
_LABEL = r"(?m)^(?:Igisubizo|Answer|Assistant|Réponse|Reponse|Jibu|A|Response)\s*:\s*|^#{1,4} ?(?:Response|Answer|Igisubizo|Réponse|Jibu)\s*$"
#: Words of other text that a contentless document may keep (a site's or person's name), twice as many beside as much residue
SPARE_WORDS = 3


def _words(x: Column) -> Column:
    return F.regexp_count(x, F.lit(r"[^\W_]+(?:['-][^\W_]+)*".replace(r"[^\W_]", r"[\p{L}\p{N}]")))


def placeholder_column(text: Column) -> Column:
    """Whether slots stand unfilled in running text."""
    bare = F.regexp_replace(text, _CODE, " ")
    # cut at sentence ends first, so that each character is looked at once, however long a line is
    sentences = F.split(bare, r"(?<=[.!?\n])")
    spoken = F.array_join(F.transform(sentences, lambda s: F.when(F.rlike(s, F.lit(_TUTORIAL)), F.lit(" ")).otherwise(s)), "")
    slot = F.lit(_SLOT)
    return F.when(F.rlike(bare, slot), F.rlike(spoken, slot) | (F.regexp_count(bare, slot) >= DENSE_SLOTS)).otherwise(False)


def contentless_column(text: Column) -> Column:
    """`filler`, `error_page` or `script_notice` where the content is nothing but that, else null."""
    body = F.regexp_replace(F.regexp_replace(text, _POSED, "\n"), _LABEL, "")
    units = F.filter(F.split(body, r"\n+|(?<=[.!?])\s+"), lambda x: F.rlike(x, F.lit(r"[\p{L}\p{N}]")))

    def told(x: Column) -> Column:
        n = _words(x)
        kind = F.when(F.lit(False), "")
        for name, pattern in KINDS.items():
            kind = kind.when(F.rlike(x, F.lit(pattern)), name)
        kind = kind.when(F.rlike(x, F.lit(_CHROME)), "chrome")
        kind = kind.when(F.regexp_count(x, F.lit(_DUMMY)) >= 0.6 * n, "filler")
        kind = kind.when(F.rlike(x, F.lit(r"\?\s*$")), "chrome").when((n <= 4) & ~F.rlike(x, F.lit(r"[.!]\s*$")), "title")
        return F.struct(F.coalesce(kind, F.lit("other")).alias("k"), n.alias("n"))

    told_units = F.transform(units, told)

    def total(kind: str) -> Column:
        return F.aggregate(F.filter(told_units, lambda u: u.k == kind), F.lit(0), lambda a, u: a + u.n)

    counts = F.struct(*[total(k).alias(k) for k in [*KINDS, "other", "title"]])

    def decide(c: Column) -> Column:
        s, e, f = c["script_notice"], c["error_page"], c["filler"]
        spare = F.greatest(F.lit(SPARE_WORDS), F.least(2 * F.lit(SPARE_WORDS), F.floor((s + e + f) * 0.8).cast("int")))
        only = (c["other"] <= spare) & (c["title"] <= 12) & (s + e + f > 0)
        return F.when(only, F.when((s >= e) & (s >= f), "script_notice").when(e >= f, "error_page").otherwise("filler"))

    return F.get(F.transform(F.array(counts), decide), F.lit(0))


#: What every slot grammar needs, for the linear scan; the grammars themselves run on the texts that have it
_SLOT_SIGNS = r"\{[\s#/&]*[A-Za-z_]|<%|\[[A-Za-z]|%[A-Z(]|__[A-Z]|#[A-Z]|«[A-Z]|XXX|TODO:|<(?i:your|votre|insert|enter|weka|shyiramo)\s"


def _linear(grammar: str) -> str:
    """A grammar for the linear-time matcher over whole texts: all that it matches in a sentence matches, and little more."""
    for told, as_ in ((r"(?<!\w)", r"\b"), (r"(?!\w)", r"\b"), (r"\s", r"[\s\x0b]")):
        grammar = grammar.replace(told, as_)
    grammar = re.sub(r"(?<!\[)\^", "", grammar)  # a sentence may begin anywhere
    return f"(?:{re.sub(r'[.][{]0,[0-9]+[}]', '.*', grammar)})"


def _dummy_signs() -> str:
    """Every sentence of which three words in five are dummy words has one of these: two that stand side by side, one that is
    part of a longer word, or, of at most five words, every other one from the first to the last. Letters beyond ASCII count
    as no letters here, which can only let more pass and keeps the matcher small."""
    d, gap, line = _linear(_DUMMY), "[^0-9A-Za-z]", r"[\n\r\x{85}\x{2028}\x{2029}]"
    part = rf"(?:[0-9A-Za-z]['-]|[^\x00-\x7f]['-]?){d}|{d}(?:['-][0-9A-Za-z]|['-]?[^\x00-\x7f])"
    whole = rf"(?:^|{line}|:|[.!?][\s\x0b]){gap}*{d}(?:[^\n]*{d})?{gap}*(?:$|{line}|[.!?][\s\x0b])"
    return rf"{d}{gap}+{d}|{part}|{whole}"


#: Contentless texts match one of these; others need not be cut into sentences
_CONTENTLESS_SIGNS = ("|".join(map(_linear, KINDS.values())), _dummy_signs())
_SCANNED = StructType([StructField("plain", StringType()), StructField("sign", BooleanType()), StructField("slot", BooleanType())])


def contentless_signs(texts: pa.Array) -> pa.Array:
    return pc.or_(*[pc.match_substring_regex(texts, x) for x in _CONTENTLESS_SIGNS])


@arrow_udf(_SCANNED)
def _scan(texts: pa.Array) -> pa.Array:
    """The plain form where it differs, and whether the text holds a sign of contentless text or of a slot: one pass of a linear-time
    matcher over Arrow memory, an order of magnitude cheaper than as many substring tests."""
    plain = [None if x is None or x.isascii() else form(x, True) for x in texts.to_pylist()]
    plain = pa.array(plain, pa.string())
    texts = pc.coalesce(plain, texts.cast(pa.string()))
    sign = pc.fill_null(contentless_signs(texts), False)
    slot = pc.fill_null(pc.match_substring_regex(texts, _SLOT_SIGNS), False)
    return pa.StructArray.from_arrays([plain, sign, slot], ["plain", "sign", "slot"])


def with_residue(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` and `kind`: null for real content."""
    seen = df.withColumn("\u0001s", _scan(F.col(text)))
    s = F.col("\u0001s")
    p = F.coalesce(s["plain"], F.col(text))
    kind = F.coalesce(F.when(s["sign"], contentless_column(p)), F.when(s["slot"] & placeholder_column(p), "placeholder"))
    return seen.withColumn("kind", kind).drop("\u0001s")


def clean_corpus(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of real content, with their columns."""
    return with_residue(df.withColumnRenamed("kind", "\u0001kind"), text).filter("kind IS NULL").drop("kind").withColumnRenamed("\u0001kind", "kind")
