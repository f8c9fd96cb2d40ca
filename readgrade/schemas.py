"""Schemas of the tables the operators exchange."""

from readgrade.fixed import METRICS

FEATURES = "filename string, " + ", ".join(f"{m} double" for m in METRICS) + ", predict_level string"
WORDLIST = "seq bigint, headword string, pos string, cefr string"
FREQUENCIES = "word string, n bigint, zipf double"
RESPONSES = "request_id bigint, attempt int, raw string"
ANSWER = "text string, questions array<string>, question1 string, question2 string"
JUDGEMENT = "level string, confidence double"
