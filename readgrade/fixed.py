"""Tables, word lists, thresholds and wordings.

They must keep exactly these values for the results to be right, so they are
stated here as plain data and nowhere else.
"""

# ---- fixed values: levels -------------------------------------------------

WORD_LEVELS = ["A1", "A2", "B1", "B2", "C1", "C2"]
LEVEL_SCORES = [("A1", 1), ("A2", 2), ("B1", 3), ("B2", 4), ("C1", 5), ("C2", 6)]
UNKNOWN_SCORE = {"profile": 4, "model": 0}

TEXT_LEVELS = ["A1.1", "A1.2", "A2.2", "B1.1", "B1.2", "B2.1", "B2.2", "C1", "C2"]
LEVEL_ORDER = [(name, i) for i, name in enumerate(TEXT_LEVELS)]

# label -> (group, display name of the group)
LEVEL_GROUPS = [
    ("A1.1", "A1", "A1 (A1.1–A1.2)"),
    ("A1.2", "A1", "A1 (A1.1–A1.2)"),
    ("A2.2", "A2", "A2 (A2.2)"),
    ("B1.1", "B1.1", "B1.1"),
    ("B1.2", "B1.2", "B1.2"),
    ("B2.1", "B2.1", "B2.1"),
    ("B2.2", "B2.2", "B2.2"),
    ("C1", "C1+", "C1+ (C1–C2)"),
    ("C2", "C1+", "C1+ (C1–C2)"),
]

# every spelling a caller may ask for -> (group, display name)
LEVEL_ALIASES = LEVEL_GROUPS + [
    ("A1", "A1", "A1 (A1.1–A1.2)"),
    ("A2", "A2", "A2 (A2.2)"),
    ("C1+", "C1+", "C1+ (C1–C2)"),
]

METRICS = ["ARI", "AvrDiff", "BperA", "CVV1", "AvrFreqRank", "VperSent", "POStypes", "LenNP"]
REPORT_METRICS = ["AvrDiff", "BperA", "CVV1", "AvrFreqRank", "ARI", "VperSent", "POStypes", "LenNP"]

# ---- fixed values: parts of speech ---------------------------------------

CONTENT_POS = {
    "profile": ["NOUN", "VERB", "ADJ", "ADV", "PROPN"],
    "model": ["NOUN", "VERB", "ADJ", "ADV"],
}
FUNCTION_POS = ["DET", "PRON", "ADP", "AUX", "CCONJ", "SCONJ", "PART", "INTJ", "PUNCT", "SPACE", "SYM"]

# part of speech as printed in a word list -> token part of speech
LIST_POS = [
    ("noun", "NOUN"),
    ("verb", "VERB"),
    ("adjective", "ADJ"),
    ("adj", "ADJ"),
    ("adverb", "ADV"),
    ("adv", "ADV"),
    ("proper noun", "PROPN"),
    ("pv", "VERB"),
    ("modal verb", "VERB"),
]

WORD_COLUMN_NAMES = ["headword", "lemma", "lemmas", "word", "単語", "見出し語"]
LEVEL_COLUMN_NAMES = ["cefr-j", "cefr", "level", "レベル", "cefr level", "cefr-j level", "level (cefr)"]
TEXT_ID_COLUMN_NAMES = ["filename", "file", "text", "text_name", "name", "id", "text_id"]

# closed word classes of English
CLOSED_CLASSES = {
    "DET": ["the", "a", "an", "this", "that", "these", "those", "each", "every", "some",
            "any", "no", "all", "both", "either", "neither", "another", "such"],
    "PRON": ["i", "you", "he", "she", "it", "we", "they", "me", "him", "her", "us", "them",
             "my", "your", "his", "its", "our", "their", "mine", "yours", "hers", "ours",
             "theirs", "who", "whom", "whose", "which", "what", "something", "nothing",
             "everything", "anyone", "someone", "everyone", "nobody", "myself", "himself",
             "herself", "itself", "themselves"],
    "AUX": ["be", "am", "is", "are", "was", "were", "been", "being", "have", "has", "had",
            "do", "does", "did", "will", "would", "shall", "should", "can", "could", "may",
            "might", "must"],
    "ADP": ["of", "in", "for", "with", "on", "at", "by", "from", "about", "into", "over",
            "after", "under", "between", "through", "during", "before", "against", "among",
            "within", "along", "across", "behind", "beyond", "near", "without", "upon",
            "toward", "towards"],
    "CCONJ": ["and", "or", "but", "nor", "yet"],
    "SCONJ": ["because", "although", "though", "while", "if", "unless", "since", "until",
              "whereas", "when", "where", "whether", "as", "than"],
    "PART": ["not", "to"],
    "INTJ": ["oh", "yes", "hello", "hi", "hey", "wow", "please"],
    "NUM": ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten",
            "hundred", "thousand", "million"],
}
# clitics, with a straight apostrophe; 's after a pronoun is a verb
CLITICS = {"n't": "PART", "'ll": "AUX", "'re": "AUX", "'ve": "AUX", "'m": "AUX", "'d": "AUX", "'s": "PART"}
# what is left of a verb before n't where it is no word of its own
CLITIC_STEMS = ["ca", "wo", "sha", "ai"]
# a point after these ends no sentence: before a name, and before a small letter, a digit or a comma
TITLES = ["mr", "mrs", "ms", "messrs", "dr", "prof", "st", "rev", "hon", "gen", "col", "capt", "lt", "sgt", "gov", "sen"]
ABBREVIATIONS = ["etc", "vs", "approx", "inc", "ltd", "co", "corp", "dept", "est", "fig", "figs", "vol", "jr", "sr", "ave", "cf", "al",
                 "jan", "feb", "aug", "sept", "oct", "nov", "dec"]
EXTRA_STOP_WORDS = ["very", "just", "also", "too", "only", "here", "there", "then", "now",
                    "so", "more", "most", "much", "many", "how", "why", "again", "once", "own",
                    "same", "other", "few", "up", "down", "out", "off"]
STOP_WORDS = [w for words in CLOSED_CLASSES.values() for w in words] + EXTRA_STOP_WORDS

# word endings of at least MIN_SUFFIX_WORD letters that decide an open class
MIN_SUFFIX_WORD = 5
OPEN_CLASS_SUFFIXES = [
    ("ADV", ["ly"]),
    ("VERB", ["ing", "ed", "ize", "ise", "ify"]),
    ("ADJ", ["ous", "ful", "less", "ble", "ive", "ish", "ic", "al"]),
]
POS_TAGS = ["NOUN", "VERB", "ADJ", "ADV", "PROPN", "DET", "PRON", "AUX", "ADP", "CCONJ",
            "SCONJ", "PART", "INTJ", "NUM", "PUNCT", "SPACE", "SYM", "X"]

# ---- fixed values: frequency ---------------------------------------------

FALLBACK_RANK = 100_000
FREQUENCY_LEVEL_CUTS = [(4.5, "A1"), (4.0, "A2"), (3.5, "B1"), (3.0, "B2"), (2.5, "C1")]
ADVANCED_BAND_RANK = 7000
TRIMMED_TOKENS = 3

# ---- fixed values: reading bands -----------------------------------------

# band, anchor level, highest rank, words, narrative topic, expository topic
BANDS = [
    ("2K", "A1", 2000, 200, "A new friend at the community park", "Morning routines for healthy students"),
    ("3K", "A1", 3000, 200, "Helping at the school festival", "How school clubs welcome new members"),
    ("4K", "A2", 4000, 200, "A family trip to the science museum", "Why communities start recycling projects"),
    ("5K", "B1.2", 5000, 200, "A teen journalist covering a local mystery", "Strategies for students to manage stress"),
    ("6K", "B2.2", 6000, 200, "Preparing for an international debate competition",
     "How coastal towns adapt to climate change"),
    ("7K", "C1+", 7000, 200, "A researcher confronting ethical choices in AI labs",
     "Long-term impacts of global data governance policies"),
]
TEXT_TYPES = ["narrative", "expository"]
DEFAULT_TOPIC = "Daily life"

# level, ARI range, word-count range
LEVEL_BOUNDARIES = [("A1.1", 0, 2, 50, 100), ("A1.2", 2, 3, 100, 150), ("A2.2", 3, 5, 150, 200)]

# ---- fixed values: advice per metric -------------------------------------

# metric, threshold, wording when too high, wording when too low
ADVICE = [
    ("AvrDiff", 0.15,
     "Replace higher-level vocabulary with CEFR-J A-level synonyms until average difficulty drops toward {target} (currently +{diff}).",
     "Introduce a few B-level content words so average difficulty rises toward {target} (currently {diff})."),
    ("BperA", 0.1,
     "Reduce the proportion of B-level content words by swapping them for A-level alternatives.",
     "Add a handful of B-level words to avoid oversimplification."),
    ("CVV1", 0.05,
     "Reuse core verbs or repeat key verb lemmas to lower verb diversity.",
     "Introduce additional distinct verbs to increase diversity."),
    ("AvrFreqRank", 50.0,
     "Choose more common vocabulary items from the CEFR-J list to lower the average frequency rank.",
     "Incorporate a few topic-appropriate mid-frequency words to avoid being overly basic."),
    ("ARI", 0.5,
     "Break long sentences or shorten words to reduce ARI toward {target}.",
     "Combine short sentences or add clauses to raise ARI toward {target}."),
    ("VperSent", 0.1,
     "Use simpler sentence structures with fewer verbs per sentence.",
     "Add supporting clauses with verbs to reach the target density."),
    ("POStypes", 0.02,
     "Limit parts-of-speech variety; reuse established patterns to reduce diversity.",
     "Include more adjectives/adverbs or alternate sentence patterns to raise POS diversity."),
    ("LenNP", 0.5,
     "Split long noun phrases into shorter units or add determiners/pronouns to simplify.",
     "Extend noun phrases with modifiers to increase their average length."),
]
ADVICE_NONE = "Metrics already align; focus on fluency and naturalness within the level."

METRIC_HINTS = [
    ("AvrDiff", "Average CEFR difficulty of content words (1=A1 … 6=C2). Keep vocabulary near the target difficulty."),
    ("BperA", "Ratio of B-level to A-level content words. Lower values mean simpler vocabulary."),
    ("CVV1", "Verb diversity. Use a controlled set of verbs when the target is low."),
    ("AvrFreqRank", "Average frequency rank (lower is more common). Choose common words when target is low."),
    ("ARI", "Automated Readability Index. Shorter words/sentences reduce this value."),
    ("VperSent", "Average verbs per sentence. Simpler constructions use fewer verbs."),
    ("POStypes", "POS diversity. Limit variety to simplify when necessary."),
    ("LenNP", "Average noun phrase length per sentence. Use compact noun phrases if the target is low."),
]
HINTS_NONE = "- Follow standard CEFR-J readability expectations."

CONVERGED_DISTANCE = 0.1
MAX_ITERATIONS = 5

# ---- fixed values: prompt guides -----------------------------------------

STYLE_GUIDES = [
    ("A1", "Use present simple and very common phrases. Keep sentences under 10 words with concrete vocabulary."),
    ("A2", "Use present and past simple with occasional future forms. Maintain short clear sentences on familiar topics."),
    ("B1.1", "Various tenses. Compound sentences. Concrete topics with some abstract ideas."),
    ("B1.2", "Complex sentences allowed. Mix of concrete and abstract topics."),
    ("B2.1", "Sophisticated grammar. Abstract concepts. Some idiomatic expressions."),
    ("B2.2", "Advanced structures. Nuanced vocabulary. Complex argumentation."),
    ("C1+", "Near-native complexity. Implicit meanings. Wide range of expressions including nuanced vocabulary."),
]
STYLE_GUIDE_DEFAULT = "Standard English appropriate for the level."

TYPE_GUIDES = [
    ("narrative", "Narrative prose with characters, events, and a clear beginning–middle–end. "
                  "Use temporal connectors and a personal or character-driven voice."),
    ("expository", "Expository/informational prose that explains facts or concepts clearly and logically. "
                   "Use neutral tone, topic sentences, and supporting details."),
]

# level, vocabulary, grammar, sentence length, example
LEVEL_GUIDES = [
    ("A1.1", "only the 500 most common English words", "present simple tense only, no complex structures",
     "3-8 words per sentence", "I am happy. My family is big. We eat dinner together."),
    ("A1.2", "the 750 most common English words", "present simple and continuous, basic past tense",
     "5-10 words per sentence", "Yesterday I went to school. I am studying English now."),
    ("A2.2", "the 1500 most common English words", "all basic tenses, simple connectors (and, but, because)",
     "8-12 words per sentence", "I have been to Paris before because my sister lives there."),
    ("B1.1", "common vocabulary with some less frequent words", "complex sentences, conditionals, passive voice",
     "10-15 words per sentence", "If I had known about the meeting, I would have prepared a presentation."),
    ("B1.2", "wider range including some abstract concepts", "all tenses, relative clauses, reported speech",
     "12-18 words per sentence",
     "The manager said that the project, which had been delayed, would be completed soon."),
    ("B2.1", "broad vocabulary including idiomatic expressions", "sophisticated structures, subjunctive mood",
     "15-20 words per sentence",
     "Having considered all the options, we decided that it was essential that everyone be informed immediately."),
    ("B2.2", "extensive vocabulary, technical terms", "all complex structures, nuanced expression",
     "18-25 words per sentence",
     "The implications of this decision, while not immediately apparent, will undoubtedly have far-reaching "
     "consequences for the entire organization."),
    ("C1", "sophisticated vocabulary, subtle distinctions", "native-like complexity and flexibility",
     "20-30 words per sentence",
     "The notion that technological progress invariably leads to improved quality of life is, at best, a gross "
     "oversimplification of the complex relationship between innovation and human welfare."),
    ("C2", "complete mastery including rare and literary forms", "full native speaker competence",
     "varied, up to 35 words",
     "One might venture to suggest that the zeitgeist of our epoch, characterized as it is by an almost "
     "pathological obsession with immediacy, militates against the cultivation of those contemplative virtues "
     "upon which genuine wisdom has traditionally been thought to depend."),
]
LEVEL_GUIDE_DEFAULT = "B1.1"

# level, shortest sentence, longest sentence, vocabulary size, grammar
BASIC_GUIDES = [("A1.1", 3, 8, 500, "present simple")]

# level, text type, order, template
TEMPLATES = [
    ("A1", "narrative", 1, "This is {character}. {character} lives in {place}. Every day {character} {daily_activity}."),
    ("A1", "narrative", 2, "One day, {character} meets {friend}. They {shared_activity} and feel {feeling}."),
    ("A1", "narrative", 3, "At night, {character} thinks about {simple_dream} and feels {emotion}."),
    ("A1", "expository", 1, "{topic} is about {simple_fact}. People use it to {simple_use}."),
    ("A1", "expository", 2, "It is usually found in {simple_location}. Many people think it is {adjective}."),
    ("A1", "expository", 3, "When you see {topic}, you can {simple_action} and feel {emotion}."),
]
# slot -> default content; {topic} stands for the topic of the request
TEMPLATE_CONTENT = [
    ("topic", "{topic}"),
    ("character", "Sora"),
    ("place", "a small town"),
    ("daily_activity", "walks to school with a smile"),
    ("friend", "Mika"),
    ("shared_activity", "play in the park"),
    ("feeling", "happy"),
    ("simple_dream", "sharing stories with friends"),
    ("emotion", "calm"),
    ("simple_fact", "{topic} helps people every day"),
    ("simple_use", "learn new things"),
    ("simple_location", "many towns"),
    ("simple_action", "think about new ideas"),
    ("adjective", "helpful"),
]

LEXICAL_BRIEF = (
    "Difficulty band: {band}. Use vocabulary primarily within the most frequent {max_rank} word families. "
    "If an unavoidable higher-level word appears, immediately support it with a simple paraphrase or explanation. "
    "Avoid strings of low-frequency phrasal verbs or idioms that would exceed the band expectations."
)
QUESTION_RULES = (
    "Question design requirements:\n"
    "- question1: Ask learners to reconstruct a key sequence, cause, or factual explanation from the passage. "
    "Reference concrete details from the text and finish with『50語程度で答えてください。』\n"
    "- question2: Ask learners to interpret motives, consequences, or implications using explicit evidence from "
    "the passage. Mention the topic explicitly and finish with『50語程度で答えてください。』"
)
STRUCTURED_PROMPT = """
        You are an expert English writer producing a CEFR {display} {text_type} reading passage about "{topic}".

        Constraints:
        - Target length: between {min_words} and {max_words} English words (aim for {word_count}). Revise internally until you satisfy this window.
        - {lexical_brief}
        - Maintain syntax and cohesion typical for CEFR {display} learners.
        - Text type requirement: {type_guide}

        Readability Targets (match quantitative metrics):
        {targets}

        Style Guidelines for {level}:
        {style_guide}

        {question_rules}

        Workflow:
        1. Plan the {text_type} structure internally (do not output the outline).
        2. Draft the passage respecting all constraints above.
        3. Compose two questions in Japanese that satisfy the question design requirements.
        4. Respond ONLY with a JSON object (no prose, no code fences):
           {
             "text": "... English passage ...",
             "question1": "... Japanese comprehension question ... 50語程度で答えてください。",
             "question2": "... Japanese comprehension question ... 50語程度で答えてください。"
           }
        """
LEVEL_PROMPT = """
Generate a {word_count}-word English text about "{topic}" at CEFR level {level}.

{emphasis} Requirements for {level}:
- Vocabulary: Use {vocabulary}
- Grammar: {grammar}
- Sentence length: {sentence_length}

Style example for {level}:
"{example}"

Important instructions:
1. Match the complexity level EXACTLY
2. Make the text natural and engaging
3. Stay strictly within the {level} constraints
4. Write between {lower} and {upper} words (not fewer or more)
5. Output only the text (no headings, no explanations)

Generate the text now:
"""
BASIC_PROMPT = """
    Generate a {word_count}-word English text about "{topic}".
    
    Requirements for {level} level:
    - Sentence length: {shortest}-{longest} words
    - Use only: {grammar}
    - Vocabulary: top {vocabulary_size} most common words
    - Style: Simple, clear, concrete examples
    
    Text:
    """
INITIAL_PROMPT = (
    "Write a CEFR {level} {text_type} English text about {topic}. About 200 words. "
    "Ensure the text follows this requirement: {type_guide}"
)
REFINEMENT_PROMPT = """
        Adjust this text to better match {level} level:
        
        Current text: {text}
        
        Text type requirement: {type_guide}

        Metric comparison:
        {snapshot}

        Required adjustments:
        {adjustments}
        
        Revised text:
        """

# ---- fixed values: questions ---------------------------------------------

LENGTH_MARK = "50語程度"
LENGTH_SUFFIX = "。50語程度で答えてください。"
FULL_STOP = "。"
TOPIC_FALLBACK = "本文"
# text type, question number, wording
DEFAULT_QUESTIONS = [
    ("narrative", 1, "{topic} に関して本文で起きた出来事や登場人物の行動を具体的に整理し、根拠となる描写とともに50語程度で答えてください。"),
    ("narrative", 2, "{topic} の結果として登場人物が抱いた感情や学んだことを、本文の記述を引用しながら50語程度で説明してください。"),
    ("expository", 1, "{topic} について本文で示された主要なポイントや事実を要約し、重要な根拠を添えて50語程度で答えてください。"),
    ("expository", 2, "{topic} に関する本文の説明から、理由や影響を踏まえて自分の言葉で50語程度で考察を述べてください。"),
]
PADDING_QUESTION = "本文について50語程度で回答してください。"

# headings that a raw answer may carry around the passage
NUMBERED_HEADING = r"^\d+\.\s*(outline|text|passage|questions?)"
LABEL_HEADING = r"^(outline:|passage:|text:|json object:|questions:|japanese questions)"

# ---- fixed values: gates, prices -----------------------------------------

WORD_WINDOW = (180, 220)
WORD_TOLERANCE = 0.1
STRICT_AFTER_ATTEMPT = 2
ATTEMPTS_PER_PROMPT = 3
ATTEMPTS_PER_BATCH_TEXT = 3
TEMPLATE_LEVELS = ["A1"]
ITERATIVE_LEVELS = ["A2", "B1.1", "B1.2", "B2.1", "B2.2"]
# model, USD per 1000 input tokens, USD per 1000 output tokens
PRICES = [("gpt-4", 0.03, 0.06), ("gpt-3.5-turbo", 0.0015, 0.002)]
UNTRAINED_ANSWER = ("B1.1", 0.5)

# text document layout
HEADER_LABELS = ["# Band: ", "# CEFR Anchor: ", "# Type: ", "# Topic: ", "# Set Index: ", "# Generated: ", "# Word Count: "]
HEADER_RULE = "-" * 50
QUESTION_HEADING = "[質問]"

# label of a text: display name of the level, then the text type
LABEL_FORMAT = "CEFR-J Level: {display} ({type})"
