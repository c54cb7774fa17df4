"""Lexicon and pattern rules as column expressions, and the presets they run with."""

from dataclasses import dataclass, field, replace
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import any_of, hits, regex


def pattern_hits(c: Column, patterns: list[str], flags: str = "U") -> Column:
    """How many different patterns are found."""
    return reduce(add, [hits(c, p, flags).cast("int") for p in patterns], F.lit(0))


def word_hits(c: Column, lexicon: list[str]) -> Column:
    """How many different entries the text contains, as substrings."""
    return reduce(add, [F.coalesce(F.contains(c, F.lit(w)), F.lit(False)).cast("int") for w in lexicon], F.lit(0))


def any_pattern(c: Column, patterns: list[str], flags: str = "U") -> Column:
    """Whether any pattern is found: one alternation, so one pass over the text."""
    return hits(c, any_of(patterns), flags) if patterns else F.lit(False)


def first_pattern(c: Column, patterns: list[str], flags: str = "U") -> Column:
    """The first pattern in list order that is found, else null."""
    return F.coalesce(*[F.when(c.rlike(regex(p, flags)), F.lit(p)) for p in patterns])


@dataclass(frozen=True)
class Lexicons:
    """Everything that the passage and letter classifiers look for."""

    logistic: list[str]
    context_strong: list[str]
    context_weak: list[str]
    narrative: list[str]
    reflective: list[str]
    nature: list[str] = field(default_factory=list)
    emotion: list[str] = field(default_factory=list)
    light: list[str] = field(default_factory=list)
    spiritual: list[str] = field(default_factory=list)
    dark: list[str] = field(default_factory=list)
    letter_header: list[str] = field(default_factory=list)
    letter_logistic: list[str] = field(default_factory=list)
    letter_intimate: list[str] = field(default_factory=list)
    letter_dark: list[str] = field(default_factory=list)
    letter_light: list[str] = field(default_factory=list)
    second_person: list[str] = field(default_factory=lambda: [" tu ", " toi ", " te ", " ton ", " ta ", " tes ", " t'"])
    question_reject: list[str] = field(default_factory=list)
    answer_reject: list[str] = field(default_factory=list)


# The French presets. Patterns with capitals never hit text that was lower-cased first; that is their published effect.
FRENCH = Lexicons(
    logistic=[r"rendez-vous", r"\b\d+\s*h(eures?)?\b", r"\bNRF\b", r"\bGallimard\b", r"téléphon", r"coup de fil", r"\bgare\b", r"\btrain\b", r"\bavion\b", r"coin de la rue", r"\bboulevard\b", r"\brue du\b", r"\brue de\b", r"\bhôtel\b", r"\badresse\b", r"\btaxi\b", r"\bbillet\b", r"\bvalise\b", r"\bpasseport\b"],
    context_strong=[r"\bnotre hôte\b", r"\bcomme je (vous )?disais\b", r"\bje vous ai (dit|parlé)\b", r"\bje vous l'ai\b", r"\bje vous racontais\b", r"\bje vous le disais\b", r"\bla femme dont\b"],
    context_weak=[r"\bcet homme\b", r"\bce monsieur\b", r"\bvous (vous )?souvenez\b", r"\bce soir-là\b", r"\bl'autre jour\b", r"\bnotre ami\b", r"\bvous savez bien\b", r"\bcomme vous le voyez\b", r"\bn'est-ce pas\s*\?", r"\bvoyez-vous\b"],
    narrative=[r"\bMeursault\b", r"\bRieux\b", r"\bTarrou\b", r"\bCottard\b", r"\bGrand\b", r"\bRambert\b", r"\bmaman\b", r"\bCéleste\b", r"\bEmmanuel\b", r"\bSalamano\b", r"\bRaymond\b", r"\bMarie\b", r"\bJean-Baptiste\b", r"\bClamence\b", r"\bJonas\b", r"\bRateau\b", r"\bLouise\b", r"\bcher ami\b", r"\bmon cher\b", r"\bje vous en prie\b", r"\bpermettez-moi\b", r"\bMarengo\b", r"\bAlger\b", r"\bOran\b"],
    reflective="angoisse souffrir souffrance douleur joie bonheur peur espoir désespoir solitude silence vide tristesse larmes cœur âme tourment fatigue amertume détresse honte fierté absurde révolte liberté justice vérité sens mort vie destin condition lucidité courage innocence culpabilité jugement exil penser comprendre savoir croire sentir aimer vivre mourir écrire créer lutter choisir rêver douter espérer renoncer soleil mer lumière nuit ciel terre vent montagne étoiles chaleur ombre horizon".split(),
    nature="soleil mer lumière nuit ciel terre vent montagne étoiles chaleur ombre horizon pluie neige eau rivage sable aube crépuscule".split(),
    emotion="angoisse souffrir souffrance douleur joie bonheur peur espoir désespoir solitude silence vide tristesse larmes cœur âme tourment amour haine tendresse mélancolie nostalgie".split(),
    question_reject=[r"tu penses à moi", r"tu m'aimes", r"tu me manques", r"on se voit", r"on se retrouve", r"tu reviens quand"],
    answer_reject=[r"\b(cam(us)?|sartre|l[’']etranger|la peste|la chute|sisyphe)\b", r"^[-*]\s+", r"^#+\s+", r"\b(premièrement|deuxièmement|troisièmement)\b"],
)
FRENCH_LIGHT = Lexicons(
    logistic=[r"rendez-vous", r"\b\d+\s*h(eures?)?\b", r"\bNRF\b", r"\bGallimard\b", r"téléphon", r"coup de fil", r"\bgare\b", r"\btrain\b", r"\bavion\b"],
    context_strong=FRENCH.context_strong[:6],
    context_weak=[r"\bcet homme\b", r"\bce monsieur\b", r"\bvous (vous )?souvenez\b", r"\bce soir-là\b", r"\bl'autre jour\b", r"\bnotre ami\b", r"\bn'est-ce pas\s*\?"],
    narrative=[r"\bmeursault\b", r"\brieux\b", r"\btarrou\b", r"\bcéleste\b", r"\bjean-baptiste\b", r"\bclamence\b", r"\bmarengo\b", r"\boran\b", r"\balger\b"],
    reflective="joie bonheur solitude silence cœur âme absurde révolte liberté justice vérité sens mort vie lucidité courage innocence culpabilité exil soleil mer lumière nuit terre vent étoiles chaleur".split(),
    light="joie bonheur lumière soleil mer été amitié tendresse promenade respirer gratitude paix corps sel nuit étoiles".split(),
    spiritual=["dieu", "aumônier", "prêtre", "péché", "foi", "âme", "indifférence du monde", "tendre indifférence"],
    dark="meurtre crime condamnation exécution nihilisme torture massacre".split(),
    letter_header=[r"^\[.*\]$", r"^(lundi|mardi|mercredi|jeudi|vendredi|samedi|dimanche)\b", r"^\d+\s*heures?\b"],
    letter_logistic=[r"rendez-vous", r"téléphon", r"\b\d+\s*h(eures?)?\b", r"\bgare\b", r"\btrain\b", r"\brue\b", r"\bboulevard\b", r"\badresse\b", r"\bNRF\b", r"\bGallimard\b"],
    letter_intimate=[r"\bmon ch[ée]ri\b", r"\bma petite\b", r"\bmon amour\b", r"\bje t[’']", r"\bje t[’']aime\b", r"\bje t[’']embrasse\b", r"\bnotre amour\b", r"\bton visage\b", r"\bta voix\b"],
    letter_dark=[r"\bmort\b", r"\bmourir\b", r"\bmeurtre\b", r"\bcrime\b", r"\bcondamn", r"\bdésespoir\b", r"\bangoisse\b", r"\bmalheur\b"],
    letter_light="soleil lumière vent mer nuit étoiles jardin arbres pluie silence joie bonheur travail roman écrire création campagne paix".split(),
    question_reject=[r"\bmétaphysique\b", r"\btranscendance\b", r"\bdialectique\b"],
    answer_reject=FRENCH.answer_reject,
)
#: Frequent words of the synthetic test tables in the roles of the presets, so that every branch of every rule is taken.
FIXTURE = replace(
    FRENCH_LIGHT,
    logistic=[r"\bfrom\b", r"\bthis\b", r"\bavec\b", r"\bnicht\b", r"\bpara\b", r"\bdans\b"],
    context_strong=[r"\bals\b", r"\bsur\b"],
    context_weak=[r"\bauf\b", r"\bby\b", r"\bare\b", r"\bpar\b"],
    narrative=[r"\bdem\b", r"\bwas\b", r"\bThe\b"],
    reflective=["que", "est", "par", "pas", "avec", "eau", "vie"],
    nature=["eau", "ther"],
    emotion=["elle", "heit", "ción"],
    light=["ing", "ou", "ment", "chen"],
    spiritual=["tre", "ble"],
    dark=["ver", "ea"],
    letter_header=[r"^\[.*\]$", r"^(le|la|de)\b", r"^\d+\s*heures?\b"],
    letter_logistic=[r"\bavec\b", r"\bNRF\b"],
    letter_intimate=[r"\bsur\b", r"\bje t[’']"],
    letter_dark=[r"\bdans\b", r"\bpour\b"],
    letter_light=["eau", "elle", "ment", "tion"],
    second_person=[" la ", " le ", " t'"],
    question_reject=[r"\bof\b", r"\bder\b"],
    answer_reject=[r"\b(for|von)\b", r"^[-*]\s+", r"^the\b"],
)

# Library metadata, and the start of front matter. The author's name is a parameter; by default any name in capitals
# counts, which is wider than one author's.
METADATA = [r"classiques des sciences sociales", r"jean-marie tremblay", r"charles bolduc", r"cégep de chicoutimi", r"université du québec", r"bibliothèque paul-émile", r"distributed proofreaders", r"politique\s+d'utilisation", r"reproduction et rediffusion", r"édition électronique", r"domaine public au canada", r"droits d'auteur de votre pays", r"courriel\s*:", r"site web pédagogique", r"page web personnelle", r"à propos de cette édition", r"texte libre de droits", r"conversion informatique", r"http[s]?://"]


def front_matter_starts(author: str = r"[\p{Lu} -]+") -> list[str]:
    return [rf"^OEUVRES\s+D.{author}", rf"ŒUVRES\s+D.{author}", r"^REMARQUE", r"^©\s*Éditions", r"^Éditions Gallimard", r"^Tous droits de traduction", r"^GALLIMARD\s*$", r"^AVANT-PROPOS", r"^Table des matières", r"^Paru dans Le Livre de Poche", r"^Récits.Nouvelles", r"^Adaptations et Traductions", r"^Cette édition électronique", r"^À propos de cette édition", r"^Texte libre de droits"]
