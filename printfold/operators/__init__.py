from printfold.operators import children, flatten, fold, load, media, skew

__all__ = ["children", "flatten", "fold", "load", "media", "skew"]
