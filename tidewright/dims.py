"""Dimension tables of the engine. Order is meaning: the first match wins."""

from __future__ import annotations

# They must equal the data's vocabulary.
LABELS = ["ujaran kebencian", "fitnah", "disinformasi", "neutral"]
LABEL_PRIORITY = ["ujaran kebencian", "fitnah", "disinformasi"]
VALID_LABELS = ["ujaran kebencian", "fitnah", "disinformasi", "neutral", "fake", "real"]
TAG_SIGNALS = {
    "ujaran kebencian": ["ujaran kebencian", "hate speech", "sara", "rasisme", "intoleransi", "diskriminasi", "xenofobia", "bigotri", "ekstremisme", "radikalisasi", "perpecahan", "permusuhan", "kebencian"],
    "fitnah": ["fitnah", "pencemaran nama baik", "defamasi", "tuduhan palsu", "adu domba", "provokasi", "black campaign", "kampanye hitam", "serangan pribadi", "character assassination"],
    "disinformasi": ["hoax", "hoaks", "misinformasi", "disinformasi", "cek fakta", "cekfakta", "hoaks atau fakta", "fakta atau hoaks", "klarifikasi", "fact check", "kabar bohong", "berita palsu", "informasi palsu", "klikbait", "salah kaprah", "misleading"],
}
PLATFORMS = [("instagram.com", "instagram", "Instagram"), ("tiktok.com", "tiktok", "TikTok"), ("twitter.com", "twitter", "Twitter/X"), ("x.com", "twitter", "Twitter/X"), ("facebook.com", "facebook", "Facebook"), ("fb.watch", "facebook", "Facebook"), ("fb.com", "facebook", "Facebook"), ("youtube.com", "youtube", "YouTube"), ("youtu.be", "youtube", "YouTube")]
SKIP_ERRORS = ["no video", "not a video", "no media", "there is no video in this post", "no video could be found in this tweet", "media #1 is not a video", "unsupported url", "removed for violating", "removed by the uploader", "terms of service", "empty media response", "unable to load", "cannot parse data", "request range not satisfiable", "range not satisfiable"]
LOGIN_ERRORS = ["confirm you", "sign in", "login", "private", "registered users", "authentication", "permission to view this post"]
THROTTLE_ERRORS = ["403", "429", "rate", "blocked", "forbidden", "ip address is blocked", "too many requests"]
REFUSALS = ["i cannot", "i'm unable", "i am unable", "safety guideline", "violates"]
LABEL_ALIASES = {"disinformasi": "kategori_A", "fitnah": "kategori_B", "ujaran_kebencian": "kategori_C", "neutral": "kategori_D"}
LENGTH_PROFILES = ["short", "medium", "long"]
SCRIPT_TOKENS = ["[laughter]", "[sigh]"]
SPEECH_TOKENS = ["[pause]", "[laugh]", "[sigh]", "[cough]", "[breath]"]
GENDERS = ["male", "female"]
AGES = ["child", "teenager", "young adult", "middle-aged", "elderly"]
PITCHES = ["very low pitch", "low pitch", "moderate pitch", "high pitch", "very high pitch"]
AGE_PITCHES = {"child": ["high pitch", "very high pitch"], "elderly": ["low pitch", "moderate pitch"]}
PACING = {"short": "short utterance, concise", "medium": "natural conversational pacing", "long": "slightly sustained narration"}
AUGMENTATIONS = [
    ("pitch_up", "pitch_shift", "n_steps", 1.0, 3.0),
    ("pitch_down", "pitch_shift", "n_steps", -3.0, -1.0),
    ("speed_up", "time_stretch", "rate", 1.05, 1.2),
    ("speed_down", "time_stretch", "rate", 0.8, 0.95),
    ("noise_white", "white_noise", "level", 0.003, 0.01),
    ("noise_brown", "brown_noise", "level", 0.03, 0.1),
    ("noise_pink", "pink_noise", "level", 0.03, 0.1),
    ("reverb", "reverb", "room_size", 0.3, 0.7),
    ("echo", "echo", "delay_sec", 0.2, 0.5),
    ("echo", "echo", "decay", 0.3, 0.6),
    ("volume_up", "gain", "level", 1.1, 1.5),
    ("volume_down", "gain", "level", 0.5, 0.9),
    ("time_stretch_slow", "time_stretch", "rate", 0.7, 0.9),
    ("time_stretch_fast", "time_stretch", "rate", 1.1, 1.3),
]
