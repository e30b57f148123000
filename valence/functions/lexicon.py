"""Word lists and weights of the sentiment scorer.

Fixed values: the scores depend on them, so they are stated as they are.
Weights and modifiers are hundredths, which keeps all arithmetic in integers.
"""

# Words and weights (hundredths).
POSITIVE = {
    "fantastic": 95, "amazing": 95, "excellent": 90, "great": 85, "love": 90,
    "enjoyed": 80, "awesome": 90, "good": 70, "wonderful": 90, "delicious": 85,
    "happy": 80, "best": 90, "positive": 75, "superb": 90, "perfect": 95,
    "brilliant": 90, "loved": 90, "enjoy": 80, "helpful": 75, "nice": 70,
    "beautiful": 85, "recommend": 80, "flawless": 95, "outstanding": 95,
    "excited": 85, "pleased": 80, "glad": 75, "delightful": 90, "impressive": 85,
    "clean": 60, "fast": 65, "smooth": 70, "worth": 75, "solid": 70,
    "masterpiece": 98, "favorite": 85, "top-notch": 95, "super": 80,
}
NEGATIVE = {
    "terrible": 95, "horrible": 95, "worst": 98, "boring": 85, "hate": 90,
    "awful": 95, "bad": 75, "poor": 80, "disappointed": 85, "disappointing": 85,
    "waste": 85, "annoying": 80, "slow": 60, "useless": 90, "sucks": 90,
    "broken": 80, "fail": 85, "failed": 85, "trash": 95, "crap": 90,
    "garbage": 95, "hated": 90, "painful": 85, "pathetic": 90, "mess": 80,
    "unacceptable": 90, "nightmare": 95, "problem": 65, "buggy": 80, "flawed": 75,
    "regret": 85, "disaster": 95, "ugly": 80, "mediocre": 70, "dull": 75,
}
# Modifiers (hundredths). "barely" and "hardly" are negations as
# well, and a negation wins, so theirs never applies.
MODIFIERS = {
    "very": 130, "really": 130, "extremely": 150, "super": 135, "so": 125,
    "absolutely": 140, "highly": 130, "totally": 130, "completely": 140,
    "barely": 50, "hardly": 50, "somewhat": 70, "slightly": 80,
}
# Fixed values.
NEGATIONS = [
    "not", "no", "never", "hardly", "barely", "scarcely", "without", "isn't",
    "aren't", "wasn't", "weren't", "haven't", "hasn't", "don't", "doesn't",
    "didn't", "won't", "wouldn't", "can't", "cannot", "couldn't",
]
# The heart counts only with its variation selector.
POSITIVE_EMOJI = ["😊", "😀", "😃", "😄", "😍", "👍", "🔥", "✨", "❤️", "🎉", "💯"]
NEGATIVE_EMOJI = ["😞", "😢", "😡", "😠", "👎", "💔", "💩", "🤮", "😭"]

# Share of a word's weight that survives a negation, in
# hundredths, and the weight of an emoji, in millionths.
PLAIN_FACTOR = 100
NEGATED_POSITIVE_FACTOR = 85
NEGATED_NEGATIVE_FACTOR = 70
EMOJI_UNITS = 1_200_000

# Class limits and confidence constants (thousandths, tenths).
CLASS_LIMIT_MILLI = 150
BLANK_CONFIDENCE, NO_HIT_CONFIDENCE, TOP_CONFIDENCE = 500, 650, 995
FACES = {"Positive": "😊", "Negative": "😞", "Neutral": "😐"}

WORD_WEIGHTS = POSITIVE | {word: -weight for word, weight in NEGATIVE.items()}
# All keywords that a text can have.
KEYWORDS = [*WORD_WEIGHTS, *[f"not {word}" for word in WORD_WEIGHTS], "positive_emoji", "negative_emoji"]
