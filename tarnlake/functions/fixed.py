"""Values that results depend on and that therefore are given, not derived."""

# Signs counted as special besides ASCII punctuation, digits, white space and emoji.
OTHER_SPECIAL = (
    "\u0092\u2009\u0093\u0097\u200a\u009d\u0099\u202f\u0096\u2005\u0095\u0091\u009c\u3000\u2002 \u2008\u0098\u0081\u2003\u0082￼\u0083\u0084’“”–ー一▬…✦�\u00ad£\u200b•€«»°·═×士＾˘⇓↓↑←→（）§″′´¿"
    "−±∈\ufeff¢ø‚„½¼¾¹²³―⁃，ˌ¸‹›ʺˈʻ¦‐⠀‰\u0085‑≤≥‖◆●■►▼▲▴∆▻¡★☆✱ːº。¯˜¥ɪ≈†上ン：∼⁄"
    "・♡✓⊕․．⋅÷１‟；،、¨ाাी्े◦˚゜ʼ≖¤ッツシ℃√！【】‿∞➤～πه۩☛₨➩☻๑٪♥ıॽ《‘©﴿٬？▷Г♫∟™"
    "ª₪®「—❖」﴾》"
)

# The kinds of space and invisible characters that become a plain space.
VARIOUS_SPACES = "\u0020\u0009\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u00a0\u202f\u205f\u3000\u200b\u200c\u200d\u2060\ufffc\u0084"

# Punctuation as a language model reads it.
PUNCTUATION_TABLE = {
    "，": ",",
    "。": ".",
    "、": ",",
    "„": '"',
    "”": '"',
    "“": '"',
    "«": '"',
    "»": '"',
    "１": '"',
    "」": '"',
    "「": '"',
    "《": '"',
    "》": '"',
    "´": "'",
    "∶": ":",
    "：": ":",
    "？": "?",
    "！": "!",
    "（": "(",
    "）": ")",
    "；": ";",
    "–": "-",
    "—": " - ",
    "．": ". ",
    "～": "~",
    "’": "'",
    "…": "...",
    "━": "-",
    "〈": "<",
    "〉": ">",
    "【": "[",
    "】": "]",
    "％": "%",
    "►": "-",
}

# Names under which chat data call a field, and what they mean.
CHAT_KEYS = {
    "input": "user",
    "question": "user",
    "output": "assistant",
    "answers": "assistant",
    "response": "assistant",
    "context": "context",
    "prefix": "context",
    "story": "context",
    "system": "context",
    "instruction": "instruction",
    "prompt": "instruction",
    "conversation": "messages",
    "conversations": "messages",
    "plain_text": "messages",
    "turn": "messages",
    "dialog": "messages",
    "history": "messages",
}
# Names of fields within a message, in the order in which the later wins.
MESSAGE_KEYS = {"from": "role", "value": "content", "speaker": "role", "text": "content"}
# Speakers of tagged dialogues.
TAGGED_SPEAKERS = {"Human": "user", "MOSS": "assistant"}
# Bytes of the token index format: its first bytes, version, and number of each element type.
INDEX_MAGIC, INDEX_VERSION = b"MMIDIDX\x00\x00", 1
ELEMENT_CODES = {"uint8": 1, "int8": 2, "int16": 3, "int32": 4, "int64": 5, "float64": 6, "float32": 7, "uint16": 8}
# Fixed value: the vocabulary size from which token ids are stored in four bytes instead of two.
TWO_BYTE_VOCABULARY = 65_535
# Fixed value: how text is split before byte-level merges, as the public vocabularies expect it.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Fixed value: how many characters of a text the usual model of abuse reads.
TOXIC_CHARACTERS = 510
