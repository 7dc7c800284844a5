"""Template residue and error-page text: unfilled placeholders, filler, error messages and script notices in place of content.

*Units* are the sentences of all documents and their paragraphs of several sentences, numbers and case aside; exact copies are one
unit.  A small seed of trusted labels comes from general forms: a sentence that says in the first place that a page, server or request
failed, that scripts are required, that text is still to come, or that holds an unfilled field.  A form that is quoted, reported or
explained is no seed.  Every unit has a SimHash over shingles of five words.  Labels pass from unit to unit through whole connected
components of near-duplicates: partitioned SimHash tables (pairs of equal blocks) propose pairs, Hamming distance and shingle
similarity verify them.  The tables alone find few of the pairs near the lowest similarity, so shared shingles in the sets' prefixes
propose the others: no pair of similarity 0.8 or more is lost.  A document is found if one of its units has a label.

Before any pair is formed, a Bloom filter over the shingles of the units just labelled leaves only units most of whose shingles may
occur there; similarity 0.8 implies that, so ordinary text never takes part in a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, count
from operator import or_

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.common import salted_lookup, spread
from palimpsest.operators.orphans import bloom_filter, might_contain
from palimpsest.scratch import Scratch

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BLOCKS = 8
#: Two of eight blocks are equal for every pair of at most this Hamming distance.
HAMMING = 6

# The seed: general forms of notices, as alternatives of case-insensitive patterns.  They are built from what a notice says - a thing
# of the web and its failure, a browser and its scripts, a text and its absence - not from whole messages.
_THING = (
    r"(?:web ?)?(?:page|site|url|link|address|file|document|resource|server|host|service|system|application|app|request|connection|session|token|"
    r"database|backend|gateway|proxy|wiki|account|video|image|content|query|operation|lookup|domain|network|feature|article|item|browser)s?"
)
_FAILS = (
    r"(?:(?:can|could) ?(?:not|n['’]t|['’]t)|cannot|can['’]t) be (?:found|reached|located|displayed|shown|loaded|opened|retrieved|completed|processed|accessed|established|verified|resolved)"
    r"|(?:was|is|were|are)(?: not|n['’]t) (?:currently )?(?:found|available|accessible|responding|working|reachable|supported|authori[sz]ed|loading)"
    r"|(?:can['’]t|cannot|could(?: not|n['’]t)) (?:find|reach|load|open|connect|handle|process|complete|display)"
    r"|(?:does|did|do)(?: not|n['’]t) (?:exist|respond|load)|no longer (?:exists?|available|works?)|(?:is|are) no longer (?:available|here|active|supported)"
    r"|(?:has |have |was )?(?:been )?(?:expired|timed out|denied|refused|blocked|forbidden|rejected|reset by peer)|took too long"
    r"|(?:is|are) (?:temporarily |currently |momentarily |presently )?(?:unavailable|down|offline|overloaded|busy|inaccessible|undergoing|under (?:maintenance|construction))"
    r"|(?:temporarily|currently) (?:unavailable|down|offline|closed|suspended)"
    r"|(?:gave|returned|received|sent) (?:no|an? (?:invalid|empty|unexpected|bad)) (?:answer|response|reply)"
    r"|(?:met|encountered|hit|ran into) an? (?:[\w-]+ ){0,3}?(?:error|problem|condition|exception|issue)|failed\b"
    r"|(?:has been|have been|is) (?:suspended|disabled|deactivated|locked|terminated)"
    r"|may (?:be|have been) (?:broken|removed|moved|deleted|down)|was interrupted|(?:has|have) been (?:removed|deleted) (?:or|by|from)"
    r"|(?:has|have|was|were) (?:been )?moved or (?:deleted|removed|renamed|no longer)"
)
_REASON = r"(?:not found|internal server error|bad gateway|forbidden|unauthori[sz]ed|service unavailable|gateway time-?out|bad request|request time-?out|method not allowed|too many requests|gone\b|error\b|page)"
ERRORS = (
    rf"(?:^|\b(?:this|the|that|your|our|requested) )(?:[\w'’-]+ ){{0,2}}?{_THING}(?: (?:(?:that |which )?you|(?:at|on|from|for) (?:this|that|your|the requested))\b[^.!?;:]*?)?,? (?:{_FAILS})",
    rf"\bwe\b[^.!?;]*? (?:can['’]t|cannot|could(?: not|n['’]t)|are unable to|were unable to|couldn['’]t|have trouble|are having (?:trouble|problems)|['’]re having (?:trouble|problems)) ?"
    rf"(?:find|finding|reach|load|loading|open|connect|display|process|complete|locate|get|access|verify)",
    r"\bthe (?:page|file|resource|url|address|document|content) (?:you (?:requested|asked for|are (?:looking for|trying)|were (?:looking for|trying)|tried)|requested)",
    rf"(?:^|http ?|\b(?:status|error)[ :-]{{1,3}})(?:error|status|code|err)?\W{{0,3}}(?:code)?\W{{0,3}}[45]\d\d\W{{0,4}}{_REASON}",
    r"^\W{0,3}(?:http |server |proxy )?(?:error|err)\b(?: code)?\W{0,3}\d{3,4}\b",
    r"^\W{0,3}(?:access|permission)(?: is| was)? denied\W*(?:$|to |for |you |on )",
    rf"^\W{{0,3}}{_REASON}\s*[.!]?\s*$(?<!page)(?<!page[.!])",
    r"^\W{0,3}(?:(?:oops|sorry|whoops|hmm|uh-oh)\W+)?(?:page|file|url) not found|^\W{0,3}http(?: error)? [45]\d\d\b|\bthere (?:was|is|has been) an? (?:[\w-]+ )?(?:problem|error|issue) (?:connecting|loading|with (?:your|this|the))",
    r"(?:^|\bsorry\W+|\boops\W+)(?:\w+ ){0,2}?(?:an?|some|unknown) (?:[\w-]+ ){0,2}?(?:error|problem|exception) (?:has |have )?(?:occurred|happened|been encountered)",
    r"^\W{0,3}error (?:establishing|connecting|loading|opening|reading|processing|fetching|parsing|while|in|on)\b|\b(?:has been|was|is) an? (?:[\w-]+ )?(?:critical|fatal|unexpected|internal|server|unknown|technical) (?:error|problem)",
    r"\bnothing (?:was |could be )?found (?:here|at|for|matching)|\b(?:limit|quota) exceeded|^\W{0,3}(?:\w+ )?unavailable (?:for|due to|because)|scheduled maintenance\W*$",
    r"\byou (?:have been|were|are|['’]ve been) (?:temporarily |permanently )?(?:blocked|banned|denied|rate.limited)|\byou['’]ve been (?:blocked|banned|denied)",
    r"^\W{0,3}(?:warning|notice|deprecated|fatal|exception)\s*:\s*(?:[\w\\]+\(|uncaught|undefined)",
    r"\b(?:something|it) (?:went|has gone|seems to have gone) wrong",
    r"^\W{0,3}(?:[\w-]+ ){0,2}?(?:database|fatal|parse|syntax|proxy|server|internal|runtime|application|script|lua|unknown|unexpected|connection|network|dns|ssl|php|sql)(?: [\w-]+)? error\b\s*(?:[:(.!]|in ['\"“/]|$)",
    r"^\W{0,3}(?:unable|failed) to (?:connect|load|open|fetch|retrieve|find|process|complete|resolve|establish|read|write|allocate)\b",
    r"^\W{0,3}(?:sorry\W+)?you (?:do not|don['’]t|are not|aren['’]t) (?:have|authori[sz]ed|allowed|permitted)\b[^.!?;]*?(?:permission|access|view|edit|see|rights|page)",
    r"\byou (?:must|need to|have to) (?:log|sign|be logged|be signed) ?in\b",
    r"^\W{0,3}(?:too many requests|rate limit exceeded|slow down and|quota exceeded)",
    r"^\W{0,3}traceback \(most recent call last\)|^\W{0,3}stack trace:|segmentation fault|core dumped|^\W{0,3}uncaught ",
    r"^\s*[\w.$]*\w(?:exception|error)(?:: ?| at | in )\s*\S|\b(?:err|dns|net|ssl|pr)_[a-z]+_[a-z_]{3,}",
    r"^\W{0,3}(?:sorry,? )?(?:we(?:['’]ll| will) be (?:right )?back|(?:we are|we['’]re|the site is|site) (?:currently |temporarily )?(?:down|under|doing|working on|performing|undergoing|offline))",
    r"^\W{0,3}(?:please )?(?:try again (?:later|in)|refresh (?:the|this|your) (?:page|browser)|reload (?:the|this) page)",
    # French, German, Spanish, Russian, Japanese
    r"^\W{0,3}erreur\s*:?\s*\d{3}|une erreur (?:\p{L}+ )?(?:est survenue|s['’]est produite)|(?:page|ressource|fichier|adresse)[^.!?;]*? introuvable|(?:page|service|site)[^.!?;]*? (?:momentanément |temporairement |actuellement )?indisponible|^\W{0,3}accès (?:refusé|interdit)|(?:cette|la) page[^.!?;]*? n['’](?:existe|est) p(?:as|lus)",
    r"^\W{0,3}fehler\s*:?\s*\d{3}|(?:ist|sind) ein(?: \p{L}+)? fehler aufgetreten|(?:seite|datei|adresse)[^.!?;]*? (?:wurde )?nicht (?:gefunden|verfügbar|erreichbar)|^\W{0,3}zugriff verweigert|(?:seite|dienst|server|website)[^.!?;]*? (?:derzeit |momentan |vorübergehend |zurzeit )?(?:nicht (?:verfügbar|erreichbar)|gewartet)|^\W{0,3}wartungsarbeiten",
    r"^\W{0,3}error\s*:?\s*\d{3}|(?:se ha producido|ha ocurrido|se produjo) un error|error interno del servidor|(?:página|archivo|recurso|sitio|contenido|servicio)[^.!?;]*? no (?:encontrad[oa]|existe|se encuentra|se (?:ha )?encontr|est[áa] disponible)|acceso (?:denegado|prohibido)\W*$|temporalmente (?:no disponible|fuera de servicio)",
    r"^\W{0,3}ошибка\s*:?\s*\d{3}|ошибка сервера|(?:страница|файл|ресурс|сайт|сервис)[^.!?;]*? (?:не найден|недоступ|не существует)|доступ (?:запрещ|закрыт)|произошла[^.!?;]*? ошибка",
    r"エラーが発生|サーバー ?エラー|ページ(?:が|は)?(?:見つかり|存在し)|アクセスが?(?:拒否|禁止|でき)|メンテナンス中|しばらくしてから",
)
_SCRIPT = r"(?:java ?script|scripts|scripting|cookies)"
_ENABLE = r"(?:enabled?|enabling|disabled?|turn(?:ed)? (?:it )?(?:on|off)|switch(?:ed)? (?:it )?(?:on|off)|activat(?:e|ed|ing)|allow(?:ed)?|requires?|required|needs?|needed|support(?:s|ed)?|uses|without|blocked|must|(?:not |un)available)"
SCRIPTS = (
    rf"(?:^|\b(?:please|you|your|this|the|must|to|some|our) )[^.!?;]*?{_ENABLE}[^.!?;]*?\b{_SCRIPT}\b|(?:^|[,:] ?|\b(?:as|because|that|if|once|when|unless|until|have|your) ){_SCRIPT}\b[^.!?;]*? {_ENABLE}\b",
    r"\byour browser (?:is (?:too old|not supported|out of date|outdated|unsupported)|does(?: not|n['’]t) support|has (?:them|it) (?:switched|turned))",
    r"(?:update|upgrade) (?:it|your browser|to a (?:newer|modern|supported) (?:browser|version))\b|unsupported browser",
    r"(?:(?:will|does|may|can)(?: not|n['’]t)|won['’]t) (?:load|work|function|display)[^.!?;]*? without (?:it|scripts|java ?script)",
    r"^\W{0,3}(?:checking (?:your|if|that)|verifying (?:you|that you)|(?:please )?(?:verify|prove|confirm) (?:that )?you(?:['’]re| are)|just a moment|please wait while)[^.!?;]*?(?:connection|browser|human|secure|verif|moment|redirect)?",
    r"(?:activer?|activez|nécessite|requiert|besoin)[^.!?;]*?(?:java ?script|scripts)|java ?script[^.!?;]*? (?:désactivé|requis|nécessaire|activé)",
    r"(?:aktivieren|benötigt|erfordert|einschalten|werden)[^.!?;]*?(?:java ?script|skripte)|(?:java ?script|skripte)[^.!?;]*? (?:deaktiviert|benötigt|erforderlich|aktiviert|aktivieren|ausgeschaltet)",
    r"(?:act[ií]v[aeo]|habilit[ae]|necesita|requiere|active)[^.!?;]*?(?:java ?script|scripts)|java ?script[^.!?;]*? (?:desactivado|habilitado|deshabilitado|activado|necesario)",
    r"(?:включ|нужен|требу|необходим|отключ)[^.!?;]*?(?:java ?script|скрипт)|(?:java ?script|скрипт)[^.!?;]*?(?:включ|отключ|требу|нужен|необходим)",
    r"(?:java ?script|スクリプト)[^。！？]*?(?:有効|無効|許可|必要|オン)",
)
_TEXT = r"(?:text|content|description|title|summary|name|copy|paragraph|article|entry|bio|caption|headline|message|story|something|details?)"
FILLERS = (
    r"^\W{0,3}lorem ipsum\b|\bdolor sit amet\b|^\W{0,3}sed ut perspiciatis\b|\b(?:click|tap|double-click)(?: here)? to (?:add|edit|insert|enter)\b",
    rf"^\W{{0,3}}(?:\w+ )?(?:your|insert|enter|add|type|put|write|place|edit)(?: \w+)? {_TEXT}(?: \w+)? (?:goes |go |will (?:go|appear|be) |appears )?(?:here|below)\b|^\W{{0,3}}(?:this is where )?your {_TEXT} (?:goes|will (?:go|appear|be))",
    rf"^\W{{0,3}}(?:more )?(?:this )?(?:{_TEXT}|page|section|site|information)? ?(?:is |are )?(?:coming soon|to follow\W*$|goes here|under construction\W*$|to be (?:added|announced|determined|written|completed|filled))",
    rf"^\W{{0,3}}(?:this is )?(?:an? |some |the |just )?(?:sample|dummy|filler|placeholder|example|default|test) (?:{_TEXT}|page|post|site)\b(?:\W*$|\W*(?:for|to|that|of|goes|which|please)\b)",
    rf"(?:replace|change|delete|edit|remove|overwrite) (?:this|before|me|it)\b(?: {_TEXT})?[^.!?;]*?(?:publishing|{_TEXT}|later|own)?\W*$(?<=publishing.|publishing|text.|text|content.|content|own.|own)",
    r"^\W{0,3}(?:asdf|qwer|zxcv|jkl|hjkl|foo bar|blah blah|xxx|tbd|todo|tba|fixme|n/a)\b(?:\W*$|\W+(?:asdf|qwer|blah|baz|xxx|foo|jkl|zxcv)|:)",
    r"^\W{0,3}(?:test\W+){2,}",
    r"^\W{0,3}(?:texto? de (?:relleno|ejemplo|prueba|remplissage|substitution))|(?:escriba|escribe|inserte|introduzca|ingrese)[^.!?;]*? (?:contenido|texto|aquí|nombre)|próximamente\W*$",
    r"^\W{0,3}texte? (?:à (?:remplacer|compléter|venir|insérer)|d['’]exemple|de remplissage|provisoire)|(?:votre|saisissez|insérez|entrez)[^.!?;]*? (?:texte|contenu|ici)|(?:bientôt disponible|contenu à venir)\W*$",
    r"^\W{0,3}hier (?:(?:steht|folgt|kommt|könnte)[^.!?;]*?(?:text|inhalt|seite|stehen)|entsteht)|^\W{0,3}(?:blindtext|platzhalter|beispieltext|mustertext)|(?:text|inhalt) folgt\W*$|(?:ihr|dein|geben sie)[^.!?;]*? (?:text|inhalt) (?:hier|ein)",
    r"здесь (?:будет|появится|должен быть)[^.!?;]*?(?:описание|текст|содержание|страница)|^\W{0,3}(?:текст|заполнитель)[- ](?:для|заполн|замен)|(?:введите|вставьте)[^.!?;]*? (?:текст|описание)|скоро (?:будет|появится)",
    r"ここに[^。]*?(?:入力|書|記入|入り)|(?:ダミー|サンプル|仮の)(?:テキスト|文章|本文)|準備中",
)
#: Whole sentences of one word over and over, in any language.
REPEATED = r"^\W*(\p{L}{2,})(?:[\s,]+\1\b){3,}"
#: Unfilled fields of template languages and forms, wherever they stand in a sentence; a field ends at its own closing mark or the line.
PLACEHOLDERS = (
    r"\{\{\{[^{}\n]*\}\}\}",
    r"\{\{\s*[\p{L}_][\p{L}\p{N}_.| ]*\}\}",
    r"[$#]\{[\p{L}_][\p{L}\p{N}_.]*\}",
    r"(?<![\p{L}\p{N}{])\{[\p{L}_][\p{L}\p{N}_]{2,}\}(?!\})",
    r"@@?\p{L}[\p{L}\p{N}_]+@@?(?![\p{L}\p{N}.])",
    r"%%?\p{Lu}[\p{Lu}_]{2,}%%?",
    r"%\([a-z_]+\)[sd]",
    r"(?<![\p{L}\p{N}%])%[sd](?![\p{L}\p{N}])",
    r"\[\[\[[^\[\]\n]+\]\]\]",
    r"\[(?i:insert|enter|your|add|type|fill in)\b[^\[\]\n]*\]",
    r"\[(?i:(?:first|last|full|user|company|customer|product)[ _]?name|name|year|date|month|day|place|city|town|county|country|title|author|number|source|location|district|region|population|river)\]",
    r"<%=?[^%\n]+%>",
    r"<(?i:insert|enter|your|add)\b[^<>\n]*>",
    r"<(?i:name|year|date|month|place|city|town|county|country|title|author|number|location|district|region|population|river)>",
    r"(?<![A-Za-z0-9_])(?:[A-Z]+_)*PLACEHOLDER(?:_[A-Z]+)*(?![A-Za-z0-9_])",
    r"(?<![\p{L}\p{N}{])\{\d\}(?!\})",
    r"(?<!\w)__[A-Z]{3,}__(?!\w)",
)
#: A sentence with a field holds at least one of these.
MARKS = ("{", "[", "<", "%", "@", "__", "PLACEHOLDER")
#: Quoted spans; a form inside one is quoted and no residue.
QUOTED = r"[\"“„«»”][^\"“„«»”\n]*[\"”“«»]"
#: Words that report, name or explain what follows them in the clause, and words that explain what they follow.
MENTIONS = (
    r"such as", r"called", r"named", r"(?:en)?titled", r"title of", r"phrase", r"the (?:term|word|expression|string|message|code|set|notation|variable)",
    r"magic words?", r"format strings?", r"means?", r"e\.g\.,?", r"for (?:example|instance),?", r"i (?:got|get|saw|had|keep getting)", r"explain(?:s|ed)?",
    r"tells?", r"shows?", r"us(?:e|es|ed|ing)", r"writes?", r"wrote", r"quot(?:e|es|ed)", r"handlers? for", r"history of", r"(?:essay|book|play|song|film) (?:about|on)",
)
EXPLAINED = (r"means?\b", r"stands? for\b", r"tells?\b", r"denotes?\b", r"refers? to\b", r"indicates?\b", r"has \w+ elements?\b", r"in the body of\b", r"(?:readers?|users?|visitors?|editors?|people|those) (?:who|with(?:out)?|see|get|can|cannot)\b", r"(?:is|was) (?:an?|the) (?:magic word|phrase|title|status code|term|word|name)\b")
#: Syllables into which the words of the usual mock Latin fall; fillers shuffle them.
LATIN = (
    "lor em ips um dol sit am amt con sec tet adi ad pis adip cing elit sed do eius mod temp or inc id unt ut lab dolor magna ali qua en im min ven iam "
    "nos tru exe rci tat ull amco nis quis qui ex ea com modo quat"
)

#: Stems of each family: a text with one of its forms holds at least one, so a cheap search in lower case comes before the forms.
ERROR_STEMS = (
    "not ", "n't", "n’t", "not.", "can’t", "no longer", "expired", "timed out", "denied", "refused", "blocked", "forbidden", "rejected", "reset by", "took too long", "unavailable", "offline", "overload", "inaccessible", "undergoing",
    "under maintenance", "under construction", "down", "temporarily", "currently", "gave ", "returned ", "received ", "sent ", "encountered", "met a", "hit a", "ran into", "failed", "moved or", "unable", "trouble", "problem", "you requested",
    "you asked", "you are ", "you were ", "you tried", " requested", "error", "err_", "status", "gateway", "unauthori", "bad request", "too many", "gone", "not found", "went wrong", "you must", "you need", "you have", "rate limit", "slow down", "quota",
    "traceback", "stack trace", "segmentation", "core dumped", "uncaught", "exception", "be back", "be right back", "performing", "nothing", "exceeded", "scheduled", "you've been", "you’ve been", "you were", "warning", "notice", "deprecated", "doing", "working on", "busy", "may be", "may have", "interrupted", "been removed", "been deleted", "suspended", "disabled", "deactivated", "locked", "terminated", "dns_", "net_", "ssl_", "pr_", "timeout", "try again", "refresh", "reload", "erreur", "introuvable", "indisponible", "accès", "page", "fehler", "nicht",
    "verweigert", "gewartet", "wartung", "no encontrad", "no existe", "no est", "no se ", "acceso", "temporalmente", "ошибк", "не найден", "недоступ", "не существ", "доступ", "エラー", "ページ", "アクセス", "メンテナンス", "しばらく", "403", "404",
)
SCRIPT_STEMS = ("script", "skript", "скрипт", "スクリプト", "cookies", "browser", "update it", "upgrade to", "without it", "checking", "verify", "prove", "confirm", "just a moment", "please wait")
FILLER_STEMS = (
    "lorem", "dolor sit", "perspiciatis", "click", "tap to", "tap here", " here", " below", "your ", "coming soon", "to follow", "under construction", "to be ", "sample", "dummy", "filler", "placeholder", "example", "default", "test ", "test,", "test.", "replace ", "change ", "delete ", "edit ", "remove ",
    "overwrite ", "asdf", "qwer", "zxcv", "jkl", "foo bar", "blah", "xxx", "tbd", "todo", "tba", "fixme", "n/a", "texto", "texte", "escrib", "inserte", "introduzca", "ingrese", "próximamente", "saisissez", "insérez", "entrez", "bientôt", "votre",
    "à venir", "hier ", "blindtext", "platzhalter", "folgt", "ihr", "dein", "geben sie", "здесь", "текст", "заполнитель", "введите", "вставьте", "скоро", "ここに", "ダミー", "サンプル", "仮の", "準備中",
)

_SENTENCE = r"(?<=[.!?])\s+|(?<=[。！？])|\n+"
_SENTENCES = regex.compile(_SENTENCE)
_FAMILIES = tuple(
    (stems, regex.compile("|".join(f"(?:{f})" for f in forms)))
    for stems, forms in ((ERROR_STEMS, ERRORS), (SCRIPT_STEMS, SCRIPTS), (FILLER_STEMS, FILLERS))
)
_HOLE = "(?:" + "|".join(PLACEHOLDERS) + ")"
_FIELD = regex.compile(_HOLE)
_REPEATED = regex.compile(REPEATED)
_MOCK = regex.compile(r"^\W*(?:(?:" + "|".join(sorted(LATIN.split(), key=len, reverse=True)) + r")+[\s,.;]+){7,}")
_QUOTE = regex.compile(QUOTED)
_LETTER = regex.compile(r"\p{L}")
#: In lower case: a clause from a word on that reports or names what follows, and one up to a word that explains what it follows.
_REPORTED = regex.compile(rf"\b(?:{'|'.join(MENTIONS)})\b[^.;:!?]*")
_EXPLAINED = regex.compile(rf"^[^.;:!?]*?\b(?:{'|'.join(EXPLAINED)})[^.;:!?]*")
#: A field right after the word that mentions it, with those joined to it, or before the one that explains it.
_MENTIONED_FIELD = regex.compile(
    rf"\b(?i:{'|'.join(MENTIONS)})\b[^.;:!?\[\]{{}}<>]*?{_HOLE}(?:[^.;:!?]*?{_HOLE})*|{_HOLE}[^.;:!?\[\]{{}}<>]*?\b(?i:{'|'.join(EXPLAINED)})"
)


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCES.split(text) if s.strip()]


def by_form(sentence: str) -> bool:
    """Whether a sentence is residue by its form, and neither quotes, reports nor explains one."""
    low = sentence.lower()
    if _REPEATED.search(low) or _MOCK.search(low):
        return True
    for stems, forms in _FAMILIES:
        if any(map(low.__contains__, stems)) and forms.search(low):
            rest = _QUOTE.sub(" ", low)
            if not _LETTER.search(rest):  # a quotation as a whole
                rest = low
            if forms.search(_REPORTED.sub(" ", _EXPLAINED.sub(" ", rest))):
                return True
    return False


def by_field(sentence: str) -> bool:
    """Whether a sentence holds an unfilled field that it neither quotes nor explains."""
    if not any(map(sentence.__contains__, MARKS)):
        return False
    return bool(_FIELD.search(sentence)) and bool(_FIELD.search(_MENTIONED_FIELD.sub(" ", _QUOTE.sub(" ; ", sentence))))


def label_of(piece: str) -> str | None:
    """The trusted label of a sentence or paragraph: 'form', 'field' or none.

    Sentences that are residue by their form make up at least half of a paragraph of that label; a field counts in its sentence.
    """
    parts = sentences(piece)
    size = sum(len(s) for s in parts if by_form(s))
    if size and 2 * size >= len(piece):
        return "form"
    return "field" if len(parts) == 1 and by_field(piece) else None


_WORDS = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]|[\p{L}\p{M}]+|\d+")


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of the runs of five words; numbers are alike, a shorter text is one run, a text without words none."""
    words = ["0" if w.isdigit() else w for w in _WORDS.findall(text.lower())]
    if not words:
        return np.empty(0, np.uint64)
    runs = {" ".join(words[i : i + SHINGLE_WORDS]) for i in range(max(1, len(words) - SHINGLE_WORDS + 1))}
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(r) for r in runs), np.uint64, len(runs)))


def simhash(hashes: np.ndarray) -> int:
    """64-bit SimHash: each bit is the majority over the hashes."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes)).tobytes(), "big", signed=True)


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        pieces = b.column("piece").to_pylist()
        sets = [shingles(t) for t in pieces]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        flat = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
        labels = pa.array([label_of(t) for t in pieces], pa.string())
        yield pa.RecordBatch.from_pydict(
            {"unit": b.column("unit"), "label": labels, "shingles": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))}
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        prints = [simhash(np.array(s, np.int64).view(np.uint64)) for s in b.column("shingles").to_pylist()]
        yield b.append_column("simhash", pa.array(prints, pa.int64()))


def with_simhash(units: DataFrame) -> DataFrame:
    """``units`` of at least one shingle with ``simhash`` and ``n``, the number of shingles."""
    rows = units.where(F.size("shingles") > 0).select("unit", "shingles")
    return rows.mapInArrow(_hashed, "unit string, shingles array<long>, simhash long").withColumn("n", F.size("shingles"))


def _tables(prints: DataFrame) -> DataFrame:
    """One row per (simhash, n) and SimHash table; a table's key is a pair of blocks at their places."""
    width = 64 // BLOCKS
    block = [F.shiftrightunsigned("simhash", width * i).bitwiseAND((1 << width) - 1) for i in range(BLOCKS)]
    keys = [block[a] * (1 << width) + block[b] + ((a * BLOCKS + b) << (2 * width)) for a, b in combinations(range(BLOCKS), 2)]
    return prints.withColumn("key", F.explode(F.array(*keys)))


def _prefixes(sets: DataFrame, rarity: DataFrame) -> DataFrame:
    """(unit, n, shingle): of every set its prefix, the first ``n - ceil(0.8 n) + 1`` shingles from the rarest on.

    Two sets of at least that similarity share a shingle that lies in both prefixes, so joining on it misses no pair; rare shingles
    first means that one which very many sets hold proposes few pairs.
    """
    keep = F.col("n") - F.ceil(F.round(F.col("n") * F.lit(SIMILARITY), 6)).cast("int") + 1
    counted = sets.select("unit", "n", F.explode("shingles").alias("shingle")).join(rarity, "shingle")
    ordered = counted.groupBy("unit", "n").agg(F.sort_array(F.collect_list(F.struct("seen", "shingle"))).alias("s"))
    return ordered.select("unit", "n", F.explode(F.slice(F.col("s.shingle"), F.lit(1), keep)).alias("shingle"))


def _neighbours(candidates: DataFrame, frontier: DataFrame, scratch: Scratch) -> DataFrame:
    """(unit) of the candidates with a similarity of at least ``SIMILARITY`` to a frontier unit; both have simhash, n and shingles."""
    even = F.least("n", "n2") >= SIMILARITY * F.greatest("n", "n2") - 1e-9
    near = F.bit_count(F.col("simhash").bitwiseXOR(F.col("simhash2"))) <= HAMMING
    theirs = frontier.select(F.col("unit").alias("from"), F.col("simhash").alias("simhash2"), F.col("n").alias("n2"), F.col("shingles").alias("s2"))
    probe = _tables(frontier.select("simhash", "n").distinct()).select(F.col("simhash").alias("simhash2"), F.col("n").alias("n2"), "key")
    by_print = _tables(candidates.select("simhash", "n").distinct()).join(probe, "key").where(near & even).select("simhash", "n", "simhash2", "n2").distinct()
    by_print = by_print.join(theirs.select("from", "simhash2", "n2"), ["simhash2", "n2"]).join(candidates.select("unit", "simhash", "n"), ["simhash", "n"])
    both_sides = candidates.select("shingles").unionByName(frontier.select("shingles"))
    rarity = scratch.write(both_sides.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("seen")), "rarity")
    asked = _prefixes(frontier, rarity).select(F.col("unit").alias("from"), F.col("n").alias("n2"), "shingle")
    by_prefix = _prefixes(candidates, rarity).join(asked, "shingle").where(even)
    pairs = by_print.select("unit", "from").unionByName(by_prefix.select("unit", "from")).distinct()
    both = pairs.join(theirs.select("from", "n2", "s2"), "from").join(candidates.select("unit", "n", F.col("shingles").alias("s1")), "unit")
    same = F.size(F.array_intersect("s1", "s2"))
    return both.where(same >= SIMILARITY * (F.col("n") + F.col("n2") - same) - 1e-9).select("unit").distinct()


def residue_units(units: DataFrame, scratch: Scratch, rounds: int | None = None) -> DataFrame:
    """(unit) of all units in a connected component with a trusted one.  ``units``: unit, label, shingles; materialised.

    The search starts at the units of label 'form' and adds verified neighbours round by round, until a round adds none; it fails if
    ``rounds`` are given and do not suffice.  A unit of label 'field' is residue by its field, which a near-duplicate need not have, so
    its label does not spread.  Per round, the others are scanned once against a Bloom filter over the shingles of the units just
    added (its size is bounded; a fuller one only leaves more candidates); all joins are among candidates and those units.
    """
    others = units.where(F.col("label").isNull() & (F.size("shingles") > 0))
    frontier = scratch.write(with_simhash(units.where("label = 'form'")), "trusted")
    reached = units.where(F.col("label").isNotNull()).select("unit")
    added = None
    for done in count(1):
        bloom, _ = bloom_filter(frontier.select(F.explode("shingles").alias("shingle")).distinct(), "shingle")
        if bloom is None:
            break
        bits = F.lit(bloom.first()[0])  # at most 8 MB
        shared = F.size(F.filter("shingles", lambda s: might_contain(bits, s)))
        similar = others.where(shared >= SIMILARITY * F.size("shingles") - 1e-9)
        if added is not None:
            similar = similar.join(added, "unit", "left_anti")
        candidates = scratch.write(with_simhash(similar), "candidates")
        close = _neighbours(candidates, frontier, scratch)
        frontier = scratch.write(candidates.join(close, "unit", "left_semi"), "frontier")
        if not frontier.take(1):
            break
        if done == rounds:
            raise RuntimeError(f"labels still spread after {rounds} rounds")
        new = frontier.select("unit")
        added = new if added is None else added.unionByName(new)
        if done % 20 == 0:  # else the plan grows with the rounds
            added = scratch.write(added, "added")
    return reached if added is None else reached.unionByName(added)


def _pieces(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, unit, piece): the sentences of every document and its paragraphs of several sentences."""
    rows = docs.where(F.col(doc_id).isNotNull() & (F.length(text) > 0)).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    paragraphs = spread(rows).select("doc_id", F.explode(F.split("text", r"\n\s*\n")).alias("p"))
    split = paragraphs.select("doc_id", "p", F.split("p", _SENTENCE).alias("s"))
    whole = F.when(F.size("s") > 1, F.array_append("s", F.col("p"))).otherwise(F.col("s"))
    pieces = split.select("doc_id", F.explode(whole).alias("piece")).where(F.col("piece").rlike(r"\S"))
    return pieces.withColumn("unit", F.md5(F.regexp_replace("piece", r"\d+", "0")))


def residue_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id) of the documents with residue in all or part of the text, each once.

    Null ids and null or empty texts are left out.
    """
    scratch = Scratch(docs.sparkSession, "residue")
    pieces = _pieces(docs, doc_id, text)
    distinct = pieces.groupBy("unit").agg(F.min("piece").alias("piece"))
    units = scratch.write(distinct.mapInArrow(_shingled, "unit string, label string, shingles array<long>"), "units")
    labelled = scratch.write(residue_units(units, scratch), "labelled")
    return salted_lookup(pieces.select("doc_id", "unit"), labelled, "unit", "inner").select("doc_id").distinct()


def without_residue(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents of ``residue_documents``; rows of null id or text stay."""
    found = residue_documents(docs, doc_id=doc_id, text=text)
    return docs.join(found.withColumnRenamed("doc_id", doc_id), doc_id, "left_anti")
