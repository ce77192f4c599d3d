"""The jobs, each a function of DataFrames returning a DataFrame.

bundles      cheapest exact-quantity bundles per menu (unbounded knapsack fold)
catalog      catalog cleaning (renames, benefit, dense ids)
schedule     calendar scheduling by value (occupancy and literal window rules)
graph        transition and line-of-sight edges, cycles, Hamiltonian paths, Euler test
web          links, link categories, item grids, headers, prices, composition
chunking     fixed and recursive text chunking
retrieval    BM25 / cosine exact top-k, LSH top-k, rerank, context, TF-IDF vectors
evaluation   label retrieval scores, score summary / grid / extremes
contacts     masked-number expansion, provider records, upsert with FK lookup
diagnostics  column moments, covariance, PCA scores and validation
experiment   arm assignment, balance, summaries, permutation test, retention
indexing     dense sequential ids without a single-partition window
parallelism  parallelism guard and size-checked broadcast
"""
