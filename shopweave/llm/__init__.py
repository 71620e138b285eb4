"""Operations on text corpora for training data; nothing else in the package imports this."""
