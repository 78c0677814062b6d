"""Fixed values that must equal the reference's for identical results.

FIXED VALUES (do not change; they define token ids and filter semantics):

* special tokens, in id order: [UNK] [PAD] [BOS] [EOS]  (ids 0, 1, 2, 3)
* continuation prefix for non-initial word pieces: ##
* longest word the WordPiece model will split: 100 characters (longer -> [UNK])
* target vocabulary size: 32000
* maximum sequence length: 512; minimum target length: 5 (strict >)
* test share of the train/test split: 0.005
* ignore index for padded labels: -100
* micro-batch 64, gradient accumulation 2 (batch 128)
* evaluate every 2500 optimiser steps, step 0 included
"""

UNK, PAD, BOS, EOS = "[UNK]", "[PAD]", "[BOS]", "[EOS]"
SPECIAL_TOKENS = (UNK, PAD, BOS, EOS)
UNK_ID, PAD_ID, BOS_ID, EOS_ID = 0, 1, 2, 3

CONTINUATION_PREFIX = "##"
MAX_INPUT_CHARS_PER_WORD = 100

TARGET_VOCAB_SIZE = 32000
MAX_LENGTH = 512
MIN_TARGET_LENGTH = 5
TEST_SHARE = 0.005
IGNORE_INDEX = -100
MICRO_BATCH = 64
GRAD_ACCUMULATION = 2
EVALUATION_STEPS = 2500

# Library bound, not a reference value: a vocabulary is a model that is broadcast or held as one literal.
MAX_VOCAB = 1 << 20
