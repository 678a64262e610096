"""Explicit schemas of every document and table that the engine reads or writes (DDL strings)."""

from __future__ import annotations

ENTRY = "struct<sourceLanguage:string,targetLanguage:string,architecture:string,files:map<string,struct<path:string,uncompressedHash:string>>,metrics:map<string,map<string,double>>>"
REGISTRY = f"baseUrl string, models map<string,array<{ENTRY}>>"
MODEL_CONFIG = "modelConfig struct<`enc-depth`:int,`dec-depth`:int,`transformer-ffn-depth`:int,`transformer-heads`:int,version:string>"
BATCH_REQUEST = "array<array<struct<source_language:string,target_language:string,architecture:string,score:double>>>"
CATALOG = "array<array<struct<source_language:string,target_language:string,base_model:string,architectures:array<string>,bidirectional:boolean,version:string,size:bigint,bundle:string,checksum:string,score:double>>>"
GENERATED_MODELS = "array<array<struct<source_language:string,target_language:string,architecture:string,score:double,version:string,size:bigint,bundle:string,checksum:string>>>"
GENERATED = f"version string, models {GENERATED_MODELS}"
BUNDLE_METADATA = "directory string, source_language string, target_language string, architecture string, base_model string, score double, version string, files struct<model:string,vocabulary:string,target_vocabulary:string,shortlist:string>"
FLAT_CATALOG = "id string, name string, base_model string, architectures array<string>, size bigint, version string, bundle string, checksum string, languages array<string>, voices array<struct<gender:string,language:string>>, type string"
MANIFEST_FILE = "struct<name:string,sizeBytes:bigint,sha256:string,role:string,script:string,priority:int,note:string>"
MANIFEST = f"version string, pack string, files array<{MANIFEST_FILE}>"
MODEL_SPEC = "stem string, url string, hf struct<repo_id:string,filename:string>, kind string, note string, opset int, pir boolean, tier string, script string"
ASSET_PIN = "url string, dest string, sha256 string"
STRIP_SHARD = "rgb binary, matte binary, weight binary, foreground binary, background binary"
STRIP_LINEAGE = "index bigint, shard string, row int, text string, script string, font string, native_h int, stroke_w int, stroke_ratio double, weight_target double, foreground_rgb array<double>, foreground_rgb_end array<double>, background_rgb array<double>, width int, height int"
PHONEME_MAP = "phoneme_id_map map<string,array<int>>"
PREDICTION = "strip_id bigint, output string, px int, v float"
LABEL = "strip_id bigint, px int, matte float, weight float, fg array<float>, bg array<float>"
