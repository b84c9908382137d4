from printfold.functions import predicates, scalars

__all__ = ["predicates", "scalars"]
