"""Named character classes, as the inside of a regular expression's brackets, and mapping pairs.

The four diacritic classes differ and are kept apart: each belongs to the functions that name it.
"""

# fixed values: diacritics, by the function that strips them
DIACRITICS_NORMALISE = "ً-ٰٟۖ-ۭـٓ-ٕ‌-‏"
DIACRITICS_PROOF = "ً-ٰٟۖ-ۭـٓ-ٕ"
DIACRITICS_BOOK = "ً-ٰٟۖ-ۭـ"
DIACRITICS_LAYOUT = "ؐ-ؚـً-ْٔ-ٰٕۖ-ۭࣣ-ࣿﱞ-ﱟ"

# fixed values: letters
ARABIC_LETTERS = "ء-ي"
ARABIC_DECODER = "؀-ۿﭐ-﻿"
ARABIC_RENDERER = "؀-ۿݐ-ݿࢠ-ࣿ"

# fixed values: letters that stand for one another, as from-characters and to-characters (none at the end: dropped)
UNIFY = ("أإآٱٲٳىئؤةۀکیء", "ااااااييوههكي")
UNIFY_LAYOUT = ("أإآٱىئٮؤةء", "اااايييوه")
GLYPH_VARIANTS = ("ھەیٮےک", "ههيييك")
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"

# fixed values: punctuation
OCR_PUNCTUATION = r"\"“”«»()\[\]{}<>#*_~^|/\\+=؛،,%$&@!?؟:‎‏‪-‮"
LAYOUT_PUNCTUATION = r"\sـ{}()\[\].,،؛:؟!'\"«»\-–—/\\0-9٠-٩◆•▪√○‘’“”"
WHITE = r"\x09-\x0d \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # what (?U)\s is
TIDY = ".,،؛:؟!"
LTR_CORE = "0-9٠-٩A-Za-z"
LTR_PUNCTUATION = r".,:;/\\\-+%=*^$#@!?\"'`~|&_"
MIRRORED = r"()\[\]{}<>«»"
MIRROR_PAIRS = ("()[]{}<>«»‹›≤≥", ")(][}{><»«›‹≥≤")
MARKER_LINE = r"\s()ۖۗ◦\d٠-٩﴾﴿۔.ًٌٍَُِّْ"
VOWEL_MARKS = "ً-ِْ"
SHADDA = "ّ"
FAKE_MARKS = "ۡۖ"
VERSE_OPEN, VERSE_CLOSE = "﴾", "﴿"
DOUBT = "⟨؟⟩"
WORD_SIGN = "[A-Za-z0-9٠-٩ض-ي]"

# fixed values: tokens of Arabic words with their marks
ARABIC_TOKEN = f"[{ARABIC_LETTERS}][{ARABIC_LETTERS}{DIACRITICS_BOOK}]*"
