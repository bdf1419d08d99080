"""Word lists. Every operator takes its own list as a parameter; these are the defaults."""

# Punctuation removed by the cleaner.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Markdown symbols removed by the noise filter.
MARKDOWN_SYMBOLS = ">*_~`"

# Strings that a CSV reader takes for a missing value.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Names of the 0/1 stress codes.
STRESS_CODES = {0: "not_stressed", 1: "stress"}

# Medication names.
MEDICATIONS = """
prozac fluoxetine zoloft sertraline lexapro escitalopram wellbutrin bupropion effexor venlafaxine
celexa citalopram paxil paroxetine cymbalta duloxetine adderall ritalin xanax alprazolam klonopin
clonazepam ativan lorazepam lithium lamictal lamotrigine seroquel quetiapine abilify aripiprazole
risperdal risperidone ambien zolpidem
""".split()

# Diagnosis phrases, one per line.
DIAGNOSES = """
depression
major depressive disorder
mdd
anxiety
generalized anxiety disorder
gad
bipolar
bipolar disorder
ptsd
post traumatic stress
ocd
obsessive compulsive
adhd
attention deficit
bpd
borderline personality
schizophrenia
psychosis
eating disorder
anorexia
bulimia
panic disorder
panic attack
social anxiety
agoraphobia
insomnia
""".strip().splitlines()

# English function words, without the apostrophe forms, which cannot occur in cleaned text.
STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very
s t can will just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma
mightn mustn needn shan shouldn wasn weren won wouldn
""".split()

# Degree words that strengthen the next sentiment word.
BOOSTERS = """
absolutely amazingly awfully completely considerable considerably decidedly deeply effing enormous
enormously entirely especially exceptional exceptionally extreme extremely fabulously flipping
flippin frackin fracking fricking frickin frigging friggin fully fuckin fucking fuggin fugging
greatly hella highly hugely incredible incredibly intensely major majorly more most particularly
purely quite really remarkably so substantially thoroughly total totally tremendous tremendously
uber unbelievably unusually utter utterly very
""".split()

# Degree words that weaken the next sentiment word.
DAMPENERS = """
almost barely hardly kinda kindof less little marginal marginally occasional occasionally partly
scarce scarcely slight slightly somewhat sorta sortof
""".split()

# Negations, spelled as they look after punctuation is removed.
NEGATIONS = """
aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt
neither neednt never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent
without wont wouldnt rarely seldom despite
""".split()

# Sentiment weights.
# Two-word dampeners, and idioms with the valence that replaces that of their lexicon word.
DAMPENER_PAIRS = ["just enough", "kind of", "sort of"]
IDIOMS = {"the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5, "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5,
          "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9}
BOOST = 0.293
NEGATION_FACTOR = -0.74
DISTANCE_DAMPING = {1: 1.0, 2: 0.95, 3: 0.9}
EMPHATIC_NEVER = 1.25
BEFORE_BUT = 0.5
AFTER_BUT = 1.5
COMPOUND_ALPHA = 15.0

# Contractions that word tokenisation splits in two.
CONTRACTIONS = {"cannot": ("can", "not"), "gimme": ("gim", "me"), "gonna": ("gon", "na"),
                "gotta": ("got", "ta"), "lemme": ("lem", "me"), "wanna": ("wan", "na")}

# Word endings that decide a part of speech when the lexicon has no entry, first hit wins.
SUFFIX_TAGS = [
    ("JJ", "ous ful less ive able ible ish ic al".split()),
    ("RB", ["ly"]),
    ("VBG", ["ing"]),
    ("VBD", ["ed"]),
]
NUMBER_TAG = "CD"
PLURAL_TAG = "NNS"
DEFAULT_TAG = "NN"
FUNCTION_WORD_TAG = "FW"


def gazetteer():
    """Default phrase → label table."""
    return {**{m: "MEDICATION" for m in MEDICATIONS}, **{d: "DIAGNOSIS" for d in DIAGNOSES}}
