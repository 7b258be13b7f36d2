"""The registered queries, their SQL counterparts, and the replay of events as a stream."""
