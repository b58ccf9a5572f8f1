"""DataFrame -> DataFrame operators: parse, vocab, vectors, select, linear, svm, logreg, evaluate."""
