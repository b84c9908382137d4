from printfold.streaming import fold, load

__all__ = ["fold", "load"]
