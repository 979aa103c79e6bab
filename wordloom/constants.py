"""Fixed values that decide results. Everything here is data, not logic."""

VOWELS = "aeiou"
ALPHABET = "abcdefghijklmnopqrstuvwxyz"

# --- fixed values: corpus gates ---------------------------------------------
NAMESPACE_PREFIXES = ("File:", "Category:", "Template:", "Wikipedia:", "Help:", "MediaWiki:")
REDIRECT_PREFIX = "#REDIRECT"
MIN_CLEAN_CHARS = 100
MIN_ARTICLE_WORDS = 20
SNAPSHOT_ARTICLES = 50_000
SNAPSHOT_MIN_FREQ = 5
FREQ_THRESHOLDS = (5, 10, 20, 50)
DICTIONARY_SIZE = 200_000
# Words rarer than this are not in the frequency table: they are no candidates and read as frequency 0.
TABLE_MIN_FREQ = 10

# --- fixed values: the entities that XML defines; ``amp`` comes last, so that its mark starts no other
XML_ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}

# --- fixed values: synthetic misspellings -----------------------------------
SEED = 42
MIN_WORD_LENGTH = 3
MAX_WORD_LENGTH = 20
CANDIDATE_WORDS = 100_000
ERROR_SAMPLES = 80_000
CORRECT_SAMPLES = 20_000
ATTEMPTS_PER_SAMPLE = 3
ERROR_TYPES = ("insertion", "deletion", "substitution", "transposition")
CORRECT_LABEL = "correct"
P_DOUBLE_LETTER = 0.8
P_DROP_VOWEL = 0.6
P_KEYBOARD = 0.4
P_CONFUSION = 0.4
KEYBOARD_NEIGHBOURS = {
    "a": "sqwz", "b": "vghn", "c": "xdfv", "d": "serfcx", "e": "wrds", "f": "drtgvc",
    "g": "ftyhbv", "h": "gyujnb", "i": "uokj", "j": "huikmn", "k": "jiolm", "l": "kop",
    "m": "njk", "n": "bhjm", "o": "iplk", "p": "ol", "q": "wa", "r": "etfd", "s": "awedxz",
    "t": "rygf", "u": "yijh", "v": "cfgb", "w": "qesa", "x": "zsdc", "y": "tuhg", "z": "asx",
}
LETTER_CONFUSIONS = {
    "a": "e", "e": "a", "i": "y", "y": "i", "k": "c", "s": "c", "c": "s", "f": "ph",
}

# --- fixed values: features --------------------------------------------------
FIRST_BIGRAMS = ("th", "in", "an", "er", "on", "re", "st", "en")
LAST_BIGRAMS = ("ed", "er", "ly", "ng", "al", "on", "es", "en")
SERVE_FIRST_BIGRAMS = ("th", "in", "an", "er", "on", "re")
SERVE_LAST_BIGRAMS = ("ed", "er", "ly", "ng", "al", "on")
CATEGORICAL = (
    "first_char", "last_char", "first_bigram", "last_bigram",
    "first_trigram", "last_trigram", "middle_char",
)
FEATURES = (
    "word_length", "num_vowels", "num_consonants", "vowel_ratio", "consonant_ratio",
    "first_char_encoded", "last_char_encoded", "first_bigram_encoded", "last_bigram_encoded",
    "first_trigram_encoded", "last_trigram_encoded", "first_bigram_common",
    "last_bigram_common", "has_double_letters", "num_double_letters", "has_repeated_vowels",
    "is_alternating", "syllable_count", "syllable_ratio", "max_consonant_cluster",
    "max_vowel_cluster", "char_diversity", "unique_vowels", "unique_consonants",
    "starts_with_vowel", "ends_with_vowel", "middle_char_encoded", "middle_is_vowel",
)

# --- fixed values: frequency bins (right-closed, lower edge excluded) --------
FREQ_BINS = (
    (10, 50, "10-50"), (50, 100, "50-100"), (100, 500, "100-500"), (500, 1000, "500-1K"),
    (1000, 5000, "1K-5K"), (5000, 10000, "5K-10K"), (10000, 50000, "10K-50K"),
    (50000, None, ">50K"),
)

# --- fixed values: split shares, correction score ----------------------------
HELD_OUT_SHARE = 0.25
TEST_SHARE_OF_HELD_OUT = 0.6
MAX_DISTANCE = 2
TOP_CORRECTIONS = 5
EXACT_SCORE = 100_000.0
