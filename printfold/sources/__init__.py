from printfold.sources import feed, images, manifest, store

__all__ = ["feed", "images", "manifest", "store"]
