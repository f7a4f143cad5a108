"""Constants: thresholds, word lists, ordered topic rules and the shipped lexicon. Data only."""

# ---------------------------------------------------------------------------------------
# Fixed values. These decide results (labels, keywords, topics), so they are stated as they
# have to be and must not be tuned.
# ---------------------------------------------------------------------------------------

POSITIVE_ABOVE = 0.05
NEGATIVE_BELOW = -0.05
ALERT_LEVEL = 0.8
WIN_MARGIN = 0.05

# dataset code -> (label, score); every other code is Neutral, 0.0
TARGET_LABELS = {0: "Negative", 2: "Neutral", 4: "Positive"}
TARGET_SCORES = {0: -0.6, 4: 0.6}
LABELS = ("Positive", "Negative", "Neutral")

# used where a post date cannot be read
FALLBACK_TIMESTAMP = "2009-06-01 00:00:00"

# columns of the display table and its CSV export
DISPLAY_COLUMNS = (
    "timestamp", "platform", "topic", "text",
    "sentiment_label", "sentiment_score", "likes", "shares",
)

# ordered: the first pattern found decides the topic
TOPIC_RULES = (
    ("Technology", "tech|ai|computer|software|code|app"),
    ("Music", "music|song|album|concert|band"),
    ("Entertainment", "movie|film|show|watch|tv|netflix"),
    ("Sports", "sport|game|play|team|win|score"),
    ("Food", "food|eat|cook|restaurant|recipe"),
    ("Work", "work|job|office|boss|career|hire"),
    ("Education", "school|class|study|learn|exam|university"),
    ("Emotions", "love|heart|miss|feel|happy|sad"),
    ("Weather", "weather|rain|sun|cold|hot|snow"),
    ("Health", "health|sick|doctor|hospital|pain|sleep"),
)
DEFAULT_TOPIC = "General"

# words never counted as keywords
STOP_WORDS = (
    "the", "be", "to", "of", "and", "a", "in", "that", "have", "i", "it", "for", "not", "on", "with", "he",
    "as", "you", "do", "at", "this", "but", "his", "by", "from", "they", "we", "say", "her", "she", "or", "an",
    "will", "my", "one", "all", "would", "there", "their", "what", "so", "up", "out", "if", "about", "who",
    "get", "which", "go", "me", "when", "make", "can", "like", "time", "no", "just", "him", "know", "take",
    "people", "into", "year", "your", "good", "some", "could", "them", "see", "other", "than", "then", "now",
    "look", "only", "come", "its", "over", "think", "also", "back", "after", "use", "two", "how", "our", "work",
    "first", "well", "way", "even", "new", "want", "because", "any", "these", "give", "day", "most", "us",
    "im", "dont", "ive", "cant", "got", "was", "am", "are", "is", "has", "had", "been", "were", "being", "did",
    "does", "doing", "really", "very", "much", "still", "going", "too", "more", "here", "right", "oh", "yeah",
    "yes", "lol", "haha", "gonna", "wanna", "gotta",
)

PLATFORMS = ("Twitter", "Reddit", "Instagram", "Facebook", "YouTube")
DEMO_TOPICS = (
    "climate change", "AI technology", "cryptocurrency", "remote work",
    "electric vehicles", "mental health", "space exploration",
    "online education", "social media regulation", "metaverse",
)

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# ---------------------------------------------------------------------------------------
# End of fixed values. Below are this project's own choices.
# ---------------------------------------------------------------------------------------

# word: (valence -4..4, polarity -1..1, subjectivity 0..1). Valences follow the scale and many of the
# mean ratings of the public VADER lexicon (Hutto and Gilbert 2014, MIT licence), polarity and
# subjectivity those of the public pattern.en adjective lexicon (De Smedt and Daelemans 2012).
LEXICON = {
    "amazing": (2.8, 0.6, 0.9), "awesome": (3.1, 0.9, 1.0), "beautiful": (2.9, 0.85, 1.0),
    "best": (3.2, 1.0, 0.3), "better": (1.9, 0.5, 0.5), "bright": (1.9, 0.7, 0.8),
    "brilliant": (2.8, 0.9, 1.0), "calm": (1.3, 0.3, 0.75), "cool": (1.3, 0.35, 0.65),
    "delightful": (2.8, 1.0, 1.0), "easy": (1.9, 0.43, 0.83), "enjoy": (2.2, 0.4, 0.5),
    "excellent": (2.7, 1.0, 1.0), "excited": (1.4, 0.375, 0.75), "fantastic": (2.6, 0.4, 0.9),
    "fine": (0.8, 0.42, 0.5), "fun": (2.3, 0.3, 0.2), "glad": (2.0, 0.5, 1.0),
    "good": (1.9, 0.7, 0.6), "great": (3.1, 0.8, 0.75), "happy": (2.7, 0.8, 1.0),
    "helpful": (1.8, 0.3, 0.4), "hope": (1.9, 0.3, 0.5), "impressive": (2.3, 1.0, 1.0),
    "incredible": (2.6, 0.9, 0.9), "innovative": (1.9, 0.5, 1.0), "interesting": (1.7, 0.5, 0.5),
    "joy": (2.8, 0.8, 0.2), "kind": (2.4, 0.6, 0.9), "like": (1.5, 0.2, 0.3),
    "love": (3.2, 0.5, 0.6), "loved": (2.9, 0.7, 0.8), "lovely": (2.8, 0.5, 0.75),
    "lucky": (1.8, 0.33, 0.83), "nice": (1.8, 0.6, 1.0), "perfect": (2.7, 1.0, 1.0),
    "pleased": (1.9, 0.5, 1.0), "positive": (2.6, 0.23, 0.55), "promising": (1.7, 0.2, 0.5),
    "proud": (2.1, 0.8, 1.0), "remarkable": (2.4, 0.75, 0.75), "safe": (1.9, 0.5, 0.5),
    "smart": (1.7, 0.21, 0.64), "smooth": (0.9, 0.4, 0.5), "solid": (0.6, 0.2, 0.3),
    "strong": (2.3, 0.43, 0.73), "success": (2.7, 0.3, 0.0), "superb": (3.1, 1.0, 1.0),
    "thanks": (1.9, 0.2, 0.2), "useful": (1.9, 0.3, 0.0), "win": (2.8, 0.8, 0.4),
    "wonderful": (2.7, 1.0, 1.0), "worth": (0.9, 0.3, 0.1), "wow": (2.8, 0.1, 1.0),
    "angry": (-2.3, -0.5, 1.0), "annoying": (-1.7, -0.8, 0.9), "awful": (-2.0, -1.0, 1.0),
    "bad": (-2.5, -0.7, 0.67), "boring": (-1.3, -1.0, 1.0), "broken": (-2.1, -0.4, 0.4),
    "concerned": (-0.9, -0.2, 0.4), "confusing": (-0.9, -0.3, 0.4), "crash": (-1.7, -0.3, 0.3),
    "cruel": (-2.8, -1.0, 1.0), "damn": (-1.7, -0.4, 0.6), "disappoint": (-1.7, -0.6, 0.6),
    "disappointed": (-2.1, -0.75, 0.75), "disappointing": (-2.2, -0.6, 0.7),
    "disaster": (-3.1, -0.7, 0.6), "dumb": (-2.3, -0.38, 0.5), "evil": (-3.4, -1.0, 1.0),
    "fail": (-2.5, -0.5, 0.3), "failed": (-2.3, -0.5, 0.3), "fear": (-2.2, -0.4, 0.6),
    "frustrating": (-1.9, -0.4, 0.4), "garbage": (-1.9, -0.6, 0.7), "hate": (-2.7, -0.8, 0.9),
    "horrible": (-2.5, -1.0, 1.0), "hurt": (-2.4, -0.4, 0.6), "idiot": (-2.3, -0.8, 0.8),
    "lie": (-1.6, -0.4, 0.4), "lost": (-1.3, -0.2, 0.2), "mess": (-1.5, -0.2, 0.2),
    "mishandled": (-1.6, -0.4, 0.5), "nasty": (-2.6, -1.0, 1.0), "pain": (-2.3, -0.4, 0.4),
    "pathetic": (-2.7, -1.0, 1.0), "poor": (-2.1, -0.4, 0.6), "problem": (-1.7, -0.2, 0.2),
    "problems": (-1.7, -0.2, 0.2), "risky": (-0.8, -0.2, 0.4), "rude": (-2.0, -0.3, 0.6),
    "sad": (-2.1, -0.5, 1.0), "scam": (-2.7, -0.6, 0.5), "shame": (-2.1, -0.4, 0.5),
    "sick": (-2.3, -0.71, 0.86), "slow": (-0.6, -0.3, 0.4), "stupid": (-2.4, -0.8, 1.0),
    "terrible": (-2.1, -1.0, 1.0), "ugly": (-2.3, -0.7, 1.0), "useless": (-1.8, -0.5, 0.2),
    "waste": (-1.8, -0.2, 0.0), "worried": (-1.2, -0.3, 0.5), "worse": (-2.1, -0.4, 0.6),
    "worst": (-3.1, -1.0, 1.0), "worthless": (-1.9, -0.8, 0.9), "wrong": (-2.1, -0.5, 0.9),
}

# degree word: shift of the valence of the word it stands before
DEGREE_SHIFT = {
    "absolutely": 0.293, "completely": 0.293, "especially": 0.293, "extremely": 0.293,
    "incredibly": 0.293, "really": 0.293, "so": 0.293, "totally": 0.293, "truly": 0.293,
    "very": 0.293,
    "barely": -0.293, "hardly": -0.293, "kinda": -0.293, "marginally": -0.293,
    "partly": -0.293, "slightly": -0.293, "somewhat": -0.293,
}
# how much of the shift is left at distance 1, 2, 3
DEGREE_DECAY = (1.0, 0.95, 0.9)
# degree word: factor on the polarity of the next word
DEGREE_FACTOR = {word: (1.3 if shift > 0 else 0.7) for word, shift in DEGREE_SHIFT.items()}

NEGATORS = (
    "not", "no", "never", "none", "nor", "without", "cannot", "cant", "can't", "dont",
    "don't", "doesnt", "doesn't", "didnt", "didn't", "isnt", "isn't", "wasnt", "wasn't",
    "wont", "won't",
)
NEGATION_FACTOR = -0.74
POLARITY_NEGATION = -0.5
CONTRAST_WORD = "but"
BEFORE_CONTRAST = 0.5
AFTER_CONTRAST = 1.5
EXCLAMATION_STEP = 0.292
EXCLAMATION_MAX = 4
CAPITALS_STEP = 0.733
COMPOUND_ALPHA = 15.0
