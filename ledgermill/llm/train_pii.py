"""Trains the network of op1 from drawn sentences and writes its weights: python -m ledgermill.llm.train_pii"""

from __future__ import annotations

import numpy as np

from .pii import DRAWN, WEIGHTS, drawn_examples, train

if __name__ == "__main__":
    np.savez(WEIGHTS, **train(drawn_examples(DRAWN)).p)
