"""Operations of a training-data pipeline: one module each, over the tables documents, pages, conversations and embeddings."""

import sys

from tagloom.session import ship

# Functions and classes travel with each query, so that workers need not have the package.
ship(sys.modules[__name__])
