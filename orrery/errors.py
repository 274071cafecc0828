"""Errors of the engine; messages of wrapped ones don't show their cause, which stays in the chain."""


class EngineError(Exception):
    pass


class InvalidBuild(EngineError):
    """The data break a rule: trying again doesn't help."""


class BuildConflict(EngineError):
    """The store holds something else than the build expects."""


class StoreUnavailable(EngineError):
    """The store failed for a reason of its own: trying again may help."""


class InvalidRequest(EngineError):
    pass


class InvalidEmbedding(EngineError):
    pass


class EmbeddingUnavailable(EngineError):
    """The embedding service failed or answered with an error; its text isn't shown."""


class SourceUnavailable(EngineError):
    """A source couldn't be read: trying again may help."""


class InvalidEvidence(EngineError):
    pass


class InvalidConfig(EngineError):
    pass


class InvalidDependencies(EngineError):
    pass


class SchemaDrift(EngineError):
    pass


class OversizeBlock(InvalidBuild):
    """An atomic block is longer than a structure chunk may be."""
