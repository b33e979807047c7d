"""Fixed word lists: stop words, category vocabularies, era markers and narrative word lists."""

from __future__ import annotations

# The common English stop-word list of 179 words.
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll", "you'd",
    "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's", "her", "hers",
    "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are", "was", "were", "be", "been",
    "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if",
    "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against", "between",
    "into", "through", "during", "before", "after", "above", "below", "to", "from", "up", "down", "in", "out",
    "on", "off", "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "don't", "should",
    "should've", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't",
    "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn", "isn't",
    "ma", "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't",
    "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
]

# Stop words kept on purpose, and words too ambiguous to keep.
KEPT_WORDS = ["no", "not", "very", "few", "more", "most", "against", "own"]
AMBIGUOUS_WORDS = ["nature", "heart", "beauty", "time"]

# Words typical of a literary movement; a repeated word counts once per repetition.
CATEGORY_WORDS = {
    "Romanticism": [
        "forlorn", "miserly", "passion", "heart", "sublime", "nature", "soul", "emotion", "beauty", "imagination",
        "dream", "vision", "melancholy", "solitude", "wild", "supernatural", "gothic", "quest", "pastoral",
        "medieval", "individualism", "spontaneous", "liberty", "innocence", "nostalgic", "mysterious", "wanderer",
    ],
    "Realism": [
        "palpable", "manifest", "society", "class", "work", "money", "family", "everyday", "objective", "accurate",
        "ordinary", "common", "realistic", "detailed", "precise", "practical", "factual", "empirical", "mundane",
        "middle-class", "city", "urban", "industrial", "scientific", "documentary", "literal", "observable",
        "concrete",
    ],
    "Naturalism": [
        "fate", "instinct", "survival", "poverty", "force", "determinism", "environment", "heredity", "struggle",
        "brutal", "harsh", "primitive", "animal", "darwinian", "savage", "scientific", "experiment", "observation",
        "lower-class", "squalor", "disease", "violence", "pessimism", "inevitable", "biological", "evolutionary",
    ],
    "Gothicism": [
        "shadow", "grave", "fear", "dark", "ghost", "horror", "supernatural", "mysterious", "castle", "ruin",
        "ancient", "terror", "death", "decay", "eerie", "monstrous", "macabre", "grotesque", "nocturnal",
        "haunted", "spectral", "melancholy", "doom", "gloomy", "curse", "omen", "diabolic", "dread", "foreboding",
        "sinister",
    ],
    "Transcendentalism": [
        "spirit", "divine", "truth", "individual", "universe", "self-reliance", "intuition", "consciousness",
        "oversoul", "nature", "harmony", "moral", "simplicity", "spiritual", "inherent", "goodness", "wilderness",
        "transcend", "enlightenment", "intellect", "meditation", "ideal", "reform", "higher", "eternal",
        "transparent", "reverence",
    ],
    "Modernism": [
        "fragment", "chaos", "memory", "time", "consciousness", "stream", "alienation", "interior", "subjective",
        "psychological", "disillusion", "existential", "cynical", "abstract", "innovation", "experiment",
        "epiphany", "urban", "flux", "relativity", "discontinuity", "skepticism", "absurd", "irony",
        "juxtaposition", "montage",
    ],
    "Renaissance": [
        "classical", "humanism", "virtue", "rhetoric", "reason", "renaissance", "pagan", "greco-roman", "courtly",
        "sonnet", "wit", "allegory", "platonic", "pastoral", "renaissance", "civilization", "worldly", "skeptical",
        "renaissance", "knowledge", "patronage", "learning", "discovery", "rebirth", "harmony", "proportion",
        "counsel",
    ],
}

# As above for the topical extraction, with merged word pairs.
CATEGORY_TERMS = {
    "Romanticism": [
        "sublime", "melancholy", "solitude", "wilderness", "supernatural", "imagination", "pastoral", "medieval",
        "individualism", "spontaneous", "liberty", "nostalgic", "wanderer", "spiritual", "transcendent", "rapture",
        "reverie", "moonlight", "myth", "legend", "yearning", "exotic", "primal", "freedom", "visionary",
        "sublime_nature", "wild_beauty", "lonely_wanderer", "mystic_vision",
    ],
    "Realism": [
        "society", "class", "work", "money", "family", "everyday", "objective", "accurate", "ordinary", "urban",
        "industrial", "scientific", "literal", "concrete", "actual", "truthful", "unvarnished", "plain", "prosaic",
        "commonplace", "labor", "trade", "daily_life", "urban_scene", "working_class", "social_order",
    ],
    "Naturalism": [
        "fate", "instinct", "survival", "poverty", "determinism", "environment", "heredity", "struggle", "brutal",
        "primitive", "darwinian", "savage", "squalor", "violence", "pessimism", "biological", "amoral", "slum",
        "tenement", "beast", "natural_selection", "grim_reality", "harsh_fate", "social_decay", "animal_instinct",
    ],
    "Gothicism": [
        "shadow", "grave", "fear", "ghost", "horror", "mysterious", "castle", "ruin", "terror", "decay", "eerie",
        "macabre", "haunted", "spectral", "doom", "sinister", "crypt", "dungeon", "villain", "specter", "vampire",
        "coffin", "graveyard", "dark_castle", "ghostly_presence", "ancient_curse", "eerie_silence",
    ],
    "Transcendentalism": [
        "spirit", "divine", "self_reliance", "intuition", "oversoul", "harmony", "moral", "simplicity",
        "spiritual", "transcend", "enlightenment", "wilderness", "solitude", "contemplation", "insight", "wisdom",
        "awakening", "self_knowledge", "cosmic_unity", "inner_peace", "natural_harmony", "divine_spirit",
    ],
    "Modernism": [
        "fragment", "chaos", "consciousness", "alienation", "subjective", "psychological", "disillusion",
        "existential", "abstract", "innovation", "urban", "relativity", "skepticism", "irony", "metropolis",
        "psychoanalysis", "symbol", "world_war", "stream_consciousness", "urban_alienation", "broken_narrative",
        "modern_anxiety",
    ],
    "Renaissance": [
        "humanism", "virtue", "rhetoric", "reason", "classical", "courtly", "sonnet", "wit", "allegory",
        "pastoral", "knowledge", "patronage", "rebirth", "proportion", "florence", "medici", "scholar",
        "vernacular", "civic_duty", "classical_ideal", "courtly_love", "learned_discourse",
    ],
}

# Words that date a text, for counting inside the text.
ERA_MARKERS = {
    "Renaissance": [
        "thee", "thou", "thy", "hath", "doth", "art", "wert", "hast", "forsooth", "methinks",
    ],
    "Romanticism/Gothic": [
        "shall", "upon", "ere", "whilst", "'tis", "thence", "whence", "aught", "naught",
    ],
    "Victorian": [
        "should", "would", "ought", "must", "quite", "indeed", "perhaps", "rather",
    ],
    "Modern": [
        "isn't", "don't", "can't", "won't", "couldn't", "shouldn't", "wouldn't",
    ],
}

# Words that date a text, for counting whole tokens.
ERA_TOKENS = {
    "Renaissance": [
        "thee", "thou", "thy", "hath", "doth", "art", "wert", "hast", "forsooth", "methinks",
    ],
    "Romanticism/Gothic": [
        "shall", "upon", "ere", "whilst", "'tis", "o'er", "amidst", "anon", "oft", "alas",
    ],
    "Victorian": [
        "should", "would", "ought", "must", "quite", "indeed", "perhaps", "rather",
    ],
    "Modern": [
        "isn't", "don't", "can't", "won't", "yeah", "okay", "like", "whatever",
    ],
}

# Narrative word lists.
NARRATIVE_WORDS = {
    "temporal_adverbs": [
        "when", "then", "whilst", "after", "before", "now", "soon", "later", "early", "previously", "subsequently",
        "immediately", "presently",
    ],
    "locative_preps": [
        "in", "at", "on", "from", "to", "toward", "between", "among", "within", "throughout", "around", "across",
        "over", "under",
    ],
    "conditional_verbs": [
        "would", "could", "should", "might", "may", "must", "ought",
    ],
    "first_person_pronouns": [
        "i", "me", "my", "mine", "myself", "we", "us", "our", "ours", "ourselves",
    ],
    "third_person_pronouns": [
        "he", "him", "his", "himself", "she", "her", "hers", "herself", "they", "them", "their", "theirs",
        "themselves",
    ],
}
# Verbs that introduce speech.
SPEECH_VERBS = [
    "said", "asked", "replied", "answered", "exclaimed", "whispered", "shouted", "murmured", "spoke", "uttered",
    "cried", "responded",
]


def stop_words(kept: list[str] | None = None, added: list[str] | None = None) -> list[str]:
    """Base list without the kept words, plus the added ones."""
    keep = set(KEPT_WORDS if kept is None else kept)
    return sorted((set(STOP_WORDS) - keep) | set(AMBIGUOUS_WORDS if added is None else added))
