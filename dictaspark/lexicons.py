"""Fixed word lists and constants, by language. Larger lists are parameters of the operators."""

from __future__ import annotations

# Fillers that disappear from a clean text.
HESITATIONS = {
    "fr": "euh eu heu hum hein bah ben ba be bon voila alors".split(),
    "en": "um uh er erm hmm mm mhm hm like well so okay ok right yeah".split(),
}

# Number words a written form replaces.
NUMBER_WORDS = {
    "fr": "un une deux trois quatre cinq six sept huit neuf dix onze douze treize quatorze quinze seize dix-sept dix-huit dix-neuf "
    "vingt trente quarante cinquante soixante quatre-vingt quatre-vingts cent cents mille million millions milliard milliards demi "
    "demie premier premiere".split(),
    "en": "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half quarter first second third "
    "fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth "
    "nineteenth twentieth thirtieth oh double triple point dot am pm www https http".split(),
}

# Digits by number word.
DIGITS_FR = {
    "zero": "0", "un": "1", "une": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "six": "6", "sept": "7", "huit": "8",
    "neuf": "9", "dix": "10", "onze": "11", "douze": "12", "treize": "13", "quatorze": "14", "quinze": "15", "seize": "16",
    "vingt": "20", "trente": "30", "quarante": "40", "cinquante": "50", "soixante": "60", "cent": "100", "cents": "100", "mille": "1000",
}

# Function words of the pair filter.
STOP_FR = (
    "le la les un une des du de d au aux a à et ou mais donc or ni car que qui quoi dont où "
    "je tu il elle on nous vous ils elles me te se lui leur y en ce cet cette ces celui celle "
    "mon ton son ma ta sa mes tes ses notre votre nos vos leurs "
    "est sont était étaient sera seront suis es sommes êtes ai as avons avez ont avait avaient "
    "pas ne plus moins très trop bien mal peu tout tous toute toutes même aussi encore déjà "
    "pour par sans sous sur dans avec chez vers entre depuis pendant avant après "
    "si comme quand alors ainsi puis enfin voilà voila "
    "the a an of and or but is are was were to in on at it its this that these those "
    "i you he she we they me him her them my your his our their be been being have has had "
    "do does did not no yes for with from by as so if then than").split()
STOP_EN = (
    "the a an of and or but is are was were to in on at it its this that these those i you he she we they me him her them my your his "
    "our their be been being have has had do does did not no yes for with from by as so if then than um uh er erm hmm mm mhm like know "
    "well okay right").split()
STOP = {"fr": STOP_FR, "en": STOP_EN}

# Function words of the structural check.
TOOLS = {
    "fr": "a à au aux avec ce cet cette ces c d de des du elle en et eux il ils je j l la le les leur lui ma mais me même mes moi mon n ne "
    "nos notre nous on ou par pas pour qu que qui s sa se ses son sur ta te tes toi ton tu un une vos votre vous y est sont était "
    "c'est qu'on d'accord il_y y_a plus moins bien très trop si non oui alors donc car or ni".split(),
    "en": "a an the and or but nor so yet for of to in on at by with from as into onto up down off over under about above below between "
    "through i me my mine you your yours he him his she her hers it its we us our ours they them their theirs this that these those "
    "who whom whose which what is am are was were be been being have has had do does did will would shall should can could may might "
    "must need dare ought not no nor n't dont don't cant can't wont won't isnt isn't if then than because since while when where why "
    "how there here very too quite rather just also only even still already ll ve re d s m t".split(),
}

# Function words that the guard takes besides those of the structural check and the pair filter.
GUARD_TOOLS = (
    "lequel laquelle lesquels lesquelles auquel auxquels auxquelles duquel desquels desquelles quelque quelques chaque autre autres tel telle "
    "tels telles ceux celles elles être avoir été étant ayant soit soient sois soyons soyez fut furent serait seraient serais aurait auraient "
    "aurais aura auront avais avions aviez étais étions étiez sien sienne siens siennes mien mienne miens miennes tien tienne tiens tiennes quel "
    "quelle quels quelles cela beaucoup seulement uniquement puisque parce afin jusque jusqu durant").split()

# Forms a word may take when the register changes, read both ways.
REGISTER = {
    "va": "aller allons allez irons irait irions",
    "peut": "pouvoir pouvons pouvez pourra pourrons pourrait pourrions puisse puissions",
    "doit": "devoir devons devez devra devrons devrait devrions falloir faut faudra",
    "fait": "faire faisons faites ferons ferait ferions fasse fassions",
    "veut": "vouloir voulons voulez voudra voudrons voudrait voudrions",
    "sait": "savoir savons savez saura saurons saurait",
    "vaut": "valoir valons vaudra vaudrait",
    "faut": "falloir faudra faudrait fallait faille devoir doit devra devrait devons",
    "aussi": "egalement",
    "vite": "rapidement",
    "fois": "parfois",
    "gens": "personnes personne gens",
    "vrai": "realite vraiment",
    "genre": "exemple",
    "ouf": "fou incroyable genial formidable",
    "bosse": "travail travailler travaille",
    "bosser": "travailler travaille travail",
    "pub": "publicite",
    "pubs": "publicites publicite",
    "notif": "notification",
    "notifs": "notifications notification",
    "perso": "personnellement personnel",
    "docu": "documentaire",
}

# Everyday words and their standard forms.
SYNONYMS = {
    "fr": {"trucs": "choses", "truc": "chose", "bagnole": "voiture", "ouais": "oui", "boulot": "travail", "dispo": "disponible"},
    "en": {"gonna": "going", "wanna": "want", "gotta": "got", "kinda": "kind", "sorta": "sort", "yeah": "yes", "yep": "yes", "nope": "no",
           "stuff": "things", "guys": "people", "cuz": "because", "dunno": "know", "lemme": "let", "gimme": "give"},
}

# Words a family may add.
EXPECTED = {
    "fr": {"email": ["bonjour", "cordialement"], "liste": ["choses", "points"], "liste_en_prose": ["choses", "points"],
           "liste_trop_courte": ["choses", "points"], "url": ["https", "www", "disponible"]},
    "en": {"email": ["hi", "hello", "hey", "dear", "thanks", "thank", "regards", "best", "cheers", "sincerely"],
           "liste": ["things", "points", "items"], "liste_en_prose": ["things", "points", "items"],
           "liste_trop_courte": ["things", "points", "items"], "url": ["https", "www", "available"]},
}

# Endings cut to a rough stem, first match wins.
SUFFIXES = {"fr": ["ees", "ee", "es", "s", "e"], "en": ["ing", "ies", "ed", "es", "s"]}

# Sources that are generated, families that must keep everything, families with their own layout.
SYNTHETIC = ["itn", "correction", "forme", "compo", "coritn"]
KEEPING = ["deja_chiffres", "sans_nombre", "non_reponse", "enfin_discursif", "double_valeur", "plutot_comparatif", "pas_vide", "affirmation",
           "question_indirecte", "liste_en_prose", "liste_trop_courte", "email_en_general", "point_ordinaire", "non_non_correctif", "deux_valeurs"]
LAID_OUT = ["liste", "email"]

# Negation patterns; the particles of French may be restored.
NEGATION = {
    "fr": r"(?iU)\b(?:ne|n['’]|pas|plus|jamais|rien|aucun[e]?s?|nul[le]*s?|ni|personne)\b",
    "en": r"(?iU)\b(?:not|never|none|nothing|nobody|neither|nor|cannot)\b|n['’]t\b|\bno\b(?!\s*,?\s*wait\b)",
}
PARTICLES = {"fr": ["ne", "n'", "n’"], "en": []}

# Words of the French test, and function words of the language drift.
FRENCH_TEST = (
    "le la les des une un du de et est que qui pas pour dans avec sur je ce mais donc alors tout plus bien fait faire chose quand meme aussi "
    "voila truc").split()
DRIFT = {
    "fr": "le la les de des du un une est et que qui pour avec dans sur pas ne vous nous ils elle c'est je il".split(),
    "es": "el la los las de que y en un una es para con por no se usted nosotros".split(),
    "de": "der die das und ist nicht mit für ein eine zu von auf sie ich wir sind".split(),
    "en": "the and with this that from have will would about because there which is are was were".split(),
}

# Closed vocabularies.
CLOSED = {
    "qc_cause": ["vide", "boucle", "langue", "sens", "invention", "effondrement", "incoherence"],
    "old_defect": ["boucle", "hallucination", "effondrement", "langue", "incoherence", "aucun"],
    "motive": ["traduction", "inversion", "invention", "suppression", "obeissance", "consigne_ignoree", "aucun", "erreur"],
    "winner": ["A", "B", "egalite"],
    "ab_fault": ["inversion", "invention", "suppression", "boucle", "obeissance", "aucune"],
    "fault": ["invention", "boucle", "suppression", "derive_longueur", "polarite"],
    "severity": ["critique", "grave", "avertissement"],
    "pii": ["email", "telephone", "iban", "adresse", "code_postal_ville", "nom_banni"],
}
SHARED_CAUSES = ["boucle", "effondrement", "langue", "incoherence"]
STYLINGS = ["casual", "semi-casual", "semi-formal", "formal"]
STRUCTURES = ["prose", "lists"]
CONTEXTS = ["general", "email"]
